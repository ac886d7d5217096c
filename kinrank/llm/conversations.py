"""Conversation structure repair: cheapest edits to a legal sequence of roles,
the least audit among them by prefix-doubling path ranking.

A conversation is legal when its roles' initials read ``(s?(ua)+)?``. Rows are
kept (K), given another role (R) or deleted (D), empty turns are inserted (I);
each state of the pattern and row is a node, each edit an arc with a cost.

1. A backward pass gives each node its cheapest cost to the end; arcs that
   keep to it are the optimal ones. Out of a node one edit leads to one node,
   so an audit names a path.
2. Nodes are ranked by their least audits of 1, 2, 4, ... letters: an audit of
   twice the length is the pair of the rank here and the rank at the node that
   the pointer reaches; the pointers double along. Final ranks choose each
   node's arc, and the least path is read off the doubled pointers.

Rows are numbered in order over range partitions and worked on in segments of
``SEGMENT`` rows, whatever conversations they hold. A conversation inside one
segment is solved there. One that crosses segments is a chain of pieces: each
gives the cheapest costs between its states as a matrix, suffix products by
doubling give every piece its cost to the end, the pieces are solved for each
state they can start in, and doubled pointers over the pieces tell which of
these it is. So no task gets a whole conversation's rows at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm.common import importable, written

SEGMENT = 8192
ROLES = {"u": "user", "a": "assistant"}
# States of the pattern: nothing yet, after s, after u, after a (the first and
# the last may end). An inserted or renamed turn is the one that is due.
STATES, ENDS = 4, (0, 3)
DUE = np.array([2, 2, 3, 2])
DUE_ROLE = ["u", "u", "a", "u"]
COST = {"D": 3, "I": 2, "K": 0, "R": 2}
TRUNCATED = 1
LETTERS = "DIKR"          # in ASCII order
FAR = 1 << 40             # no way
_SPACE = " \t\n\x0b\x0c\r"
_LOW = 33


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (``conv, turn, role, text``) with ``role`` and ``text`` without
    nulls, ``initial``, ``blank``, ``cut`` (truncated) and ``h``, a 128-bit
    hash of role and text."""
    rows = rows.withColumns({"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))})
    inked = F.rtrim(F.col("text"), F.lit(_SPACE))
    return rows.withColumns({
        "initial": F.substring("role", 1, 1), "blank": inked == "",
        "cut": (inked != "") & ~F.substring(inked, -1, 1).isin(".", "!", "?"),
        "h": F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))})


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``pos``, their place in the order of conversation, turn
    (nulls first) and hash; written once. Equal rows change places freely."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("h"), F.col("tie")]
    # the tie lets equal rows lie in several partitions
    dealt = (rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(n, *order)
             .sortWithinPartitions(*order).drop("tie").withColumn("mid", F.monotonically_increasing_id()))
    kept = written(dealt, "ordered")
    part = F.shiftright("mid", _LOW)
    sizes = kept.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return (kept.withColumn("part", part).join(F.broadcast(offset), "part")  # one row a partition
            .withColumn("pos", F.col("offset") + F.col("mid").bitwiseAND((1 << _LOW) - 1))
            .drop("part", "offset", "mid"))


# ------------------------------------------------------------ one segment

class Pieces:
    """Runs of a segment's rows, each of one conversation.

    ``begin``: first row of each piece (with the end), ``next``: the state
    after keeping each row by state (-1: not possible), ``must``: rows that
    have to be deleted, ``cut``: truncated rows.
    """

    def __init__(self, begin: np.ndarray, initial: np.ndarray, must: np.ndarray, cut: np.ndarray):
        self.begin, self.n = begin, len(initial)
        self.size = np.diff(begin)
        self.must, self.cut = must, cut.astype(np.int64) * TRUNCATED
        self.next = np.full((self.n, STATES), -1)
        self.next[initial == "s", 0] = 1
        for state in (0, 1, 3):
            self.next[initial == "u", state] = 2
        self.next[initial == "a", 2] = 3

    @staticmethod
    def inserted(cost: np.ndarray) -> np.ndarray:
        """Costs by state once turns may be inserted first (two are enough)."""
        for _ in range(2):
            cost = np.minimum(cost, COST["I"] + cost[..., DUE])
        return cost

    def costs(self, exits: np.ndarray) -> np.ndarray:
        """Cheapest cost from each node to the end of its piece: nodes are
        (row, state), rows of a piece first to last, then its exit, so row
        ``i`` of piece ``p`` is at ``i + p``. ``exits``: costs after a piece
        by state (and more axes behind)."""
        out = np.full((self.n + len(self.size), STATES, *exits.shape[2:]), FAR, np.int64)
        here = self.begin[1:] + np.arange(len(self.size))
        out[here] = exits
        shape = (-1, *[1] * (exits.ndim - 2))
        order = np.argsort(-self.size, kind="stable")
        sizes = -self.size[order]
        for back in range(1, int(self.size.max(initial=0)) + 1):
            p = order[:np.searchsorted(sizes, -back, side="right")]
            row = self.begin[p + 1] - back
            after, must, cut = out[row + p + 1], self.must[row], self.cut[row]
            best = after + COST["D"]
            for s in range(STATES):
                renamed = np.where(must.reshape(shape), FAR, after[:, DUE[s]] + (COST["R"] + cut).reshape(shape))
                to = self.next[row, s]
                kept = np.where((must | (to < 0)).reshape(shape), FAR,
                                after[np.arange(len(p)), np.maximum(to, 0)] + (COST["K"] + cut).reshape(shape))
                best[:, s] = np.minimum(best[:, s], np.minimum(renamed, kept))
            out[row + p] = np.swapaxes(self.inserted(np.swapaxes(best, 1, -1)), 1, -1) if exits.ndim > 2 \
                else self.inserted(best)
        return np.minimum(out, FAR)

    def matrices(self) -> np.ndarray:
        """Cheapest costs of each piece from state to state (16 numbers)."""
        same = np.full((STATES, STATES), FAR, np.int64)
        np.fill_diagonal(same, 0)
        got = self.costs(np.broadcast_to(same, (len(self.size), STATES, STATES)).copy())
        return got[self.begin[:-1] + np.arange(len(self.size))]

    def arcs(self, cost: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(target of each optimal arc by node and letter or -1, whether the
        node is final). ``ends``: pieces whose exit is the end of all."""
        nodes = cost.size
        flat = cost.reshape(-1)
        to = np.full((nodes, len(LETTERS)), -1)
        piece = np.repeat(np.arange(len(self.size)), self.size)
        at = (np.arange(self.n) + piece) * STATES
        exit_at = (self.begin[1:] + np.arange(len(self.size)))[ends] * STATES
        for s in range(STATES):
            for name, where, target, price, able in (
                    ("D", at + s, at + STATES + s, COST["D"], np.ones(self.n, bool)),
                    ("K", at + s, at + STATES + np.maximum(self.next[:, s], 0), COST["K"] + self.cut,
                     ~self.must & (self.next[:, s] >= 0)),
                    ("R", at + s, at + STATES + DUE[s], COST["R"] + self.cut, ~self.must),
                    ("I", at + s, at + DUE[s], COST["I"], np.ones(self.n, bool)),
                    ("I", exit_at + s, exit_at + DUE[s], COST["I"], np.ones(len(exit_at), bool))):
                good = able & (flat[where] == price + flat[target]) & (flat[where] < FAR)
                to[where[good], LETTERS.index(name)] = target[good]
        return to, (to < 0).all(axis=1)

    def least(self, cost: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The least optimal path from each start node, step by step: (start,
        letter, node before the step), and the node where each path ends."""
        to, final = self.arcs(cost, ends)
        nodes = np.arange(len(to))
        # audits of one letter
        code = np.where(final, 0, np.argmax(to >= 0, axis=1) + 1)
        pointer = np.where(final, nodes, to[nodes, np.maximum(code - 1, 0)])
        length, doubled, rank = (~final).astype(np.int64), [pointer], code
        while (length[pointer] > 0).any():
            rank = np.unique(rank * (len(to) + 5) + rank[pointer], return_inverse=True)[1]
            length = length + length[pointer]
            pointer = pointer[pointer]
            doubled.append(pointer)
        # the ranks are of whole audits now: each node takes its least arc
        key = np.where(to >= 0, (np.arange(len(LETTERS)) * (len(to) + 5)) + rank[to], np.iinfo(np.int64).max)
        choice = np.argmin(key, axis=1)
        steps = length[starts]
        who = np.repeat(np.arange(len(starts)), steps)
        j = np.arange(len(who)) - np.repeat(np.cumsum(steps) - steps, steps)
        node = starts[who]
        for bit, p in enumerate(doubled):
            node = np.where(j >> bit & 1, p[node], node)
        return who, choice[node], node, doubled[-1][starts] if len(starts) else starts

    def edits(self, cost: np.ndarray, ends: np.ndarray, pieces: np.ndarray, state: np.ndarray):
        """For each of ``pieces`` entered in ``state``: (row numbers, edits,
        roles) with one entry per row, audits, and the states after them.
        Turns inserted after the last row go with that row."""
        starts = (self.begin[pieces] + pieces) * STATES + state
        who, letter, node, last = self.least(cost, ends, starts)
        p = pieces[who]
        row = np.minimum(node // STATES - p, self.begin[p + 1] - 1)
        s = node % STATES
        names = np.array(list(LETTERS))[letter]
        role = np.where((names == "I") | (names == "R"), np.array(DUE_ROLE)[s], np.where(names == "K", "=", "-"))
        new = np.ones(len(who), bool)
        new[1:] = (who[1:] != who[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        all_names, all_roles = "".join(names), "".join(role)
        to = np.append(at, len(who))
        cuts = np.searchsorted(who, np.arange(len(pieces) + 1))
        return ((who[at], row[at], [all_names[i:j] for i, j in zip(to[:-1], to[1:], strict=True)],
                 [all_roles[i:j] for i, j in zip(to[:-1], to[1:], strict=True)]),
                [all_names[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)], last % STATES)


END = np.array([0 if s in ENDS else FAR for s in range(STATES)], np.int64)
END = Pieces.inserted(END)


def _changes(t: pa.Table) -> np.ndarray:
    """Rows of ordered rows at which another conversation begins."""
    code = t.column("conv").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
    new = np.ones(len(code), bool)
    new[1:] = code[1:] != code[:-1]
    return new


def _flags(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().fill_null(False).to_numpy(zero_copy_only=False).astype(bool)


def _of_rows(t: pa.Table) -> tuple[Pieces, np.ndarray]:
    begin = np.append(np.flatnonzero(_changes(t)), t.num_rows)
    initial = np.array(t.column("initial").to_pylist(), dtype=object)
    return Pieces(begin, initial, _flags(t, "blank") | _flags(t, "again"), _flags(t, "cut")), begin


_OUT = ("seg bigint, conv {conv}, pos bigint, edit string, role string, state int, exit int, audit string, cost bigint, "
        "n bigint, turns bigint, low bigint, high bigint, blank bigint, duplicate bigint, truncated bigint, "
        "illegal bigint, whole boolean, matrix array<bigint>")
_NAMES = [c.split()[0] for c in _OUT.split(", ")]


def _table(kinds: list, **cols) -> pa.Table:
    n = max(len(x) for x in cols.values())
    return pa.Table.from_arrays(
        [pa.array(cols[c], k) if c in cols else pa.nulls(n, k) for c, k in zip(_NAMES, kinds, strict=True)],
        names=_NAMES)


def _kinds(conv: pa.DataType) -> list:
    i, s = pa.int64(), pa.string()
    return [i, conv, i, s, s, pa.int32(), pa.int32(), s, i, i, i, i, i, i, i, i, i, pa.bool_(), pa.list_(i)]


def _first_pass(t: pa.Table) -> pa.Table:
    """Facts of each piece of a segment; edits of conversations that lie in
    it, matrices of the others. Neighbouring segments lend a row each."""
    t = t.sort_by("pos")
    seg = t.column("seg")[0].as_py()
    kinds = _kinds(t.schema.field("conv").type)
    joined = ~_changes(t)
    own = ~_flags(t, "lent")
    here = np.flatnonzero(own)
    before = here[0] > 0
    t_own = t.take(pa.array(here))
    pieces, begin = _of_rows(t_own)
    conv = t_own.column("conv").combine_chunks().take(pa.array(begin[:-1]))
    count = len(begin) - 1
    # the pair with the row before counts for the later row's piece
    initial = np.array(t.column("initial").to_pylist(), dtype=object)
    pair = np.array(["", *(a + b for a, b in zip(initial[:-1], initial[1:], strict=True))], dtype=object)
    wrong = joined & ~np.isin(pair, ["su", "ua", "au"])
    turn = t.column("turn").combine_chunks()
    told = turn.is_valid().to_numpy(zero_copy_only=False)
    value = turn.fill_null(0).to_numpy().astype(np.int64)
    fresh = told.copy()
    fresh[1:] &= ~(joined[1:] & told[:-1] & (value[1:] == value[:-1]))
    split = begin[:-1]

    def total(x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x[here].astype(np.int64), split)
    big = np.iinfo(np.int64)
    low = np.minimum.reduceat(np.where(told, value, big.max)[here], split)
    high = np.maximum.reduceat(np.where(told, value, big.min)[here], split)
    some = total(told) > 0
    blank, again, cut = (_flags(t, c) for c in ("blank", "again", "cut"))
    whole = np.ones(count, bool)
    if before and joined[here[0]]:
        whole[0] = False
    if here[-1] + 1 < len(own) and joined[here[-1] + 1]:
        whole[-1] = False
    inside, crossing = np.flatnonzero(whole), np.flatnonzero(~whole)
    cost = pieces.costs(np.broadcast_to(END, (count, STATES)))
    (who, row, edit, role), audit, _ = pieces.edits(cost, np.ones(count, bool), inside, np.zeros(len(inside), int))
    pos = t_own.column("pos").to_numpy()
    full_audit, full_cost = [None] * count, [None] * count
    for k, i in enumerate(inside):
        full_audit[i] = audit[k]
        full_cost[i] = int(cost[begin[i] + i, 0])
    matrix = [None] * count
    if len(crossing):
        found = pieces.matrices()
        for i in crossing:
            matrix[i] = found[i].reshape(-1).tolist()
    facts = _table(kinds, seg=[seg] * count, conv=conv, audit=full_audit, cost=full_cost, n=pieces.size,
                   turns=total(fresh), low=pa.array(low, mask=~some), high=pa.array(high, mask=~some),
                   blank=total(blank), duplicate=total(again & ~blank), truncated=total(cut & ~again),
                   illegal=total(wrong), whole=whole, matrix=matrix)
    made = _table(kinds, seg=[seg] * len(row), pos=pos[row], conv=conv.take(pa.array(inside[who])), edit=edit, role=role)
    return pa.concat_tables([facts, made])


def _second_pass(t: pa.Table, told: pa.Table) -> pa.Table:
    """Edits of the pieces of a segment that belong to longer conversations,
    for each state in which one may start; ``told`` has the costs after each."""
    conv_type = (t if t.num_rows else told).schema.field("conv").type
    kinds = _kinds(conv_type)
    if not t.num_rows:
        return _table(kinds, seg=pa.array([], pa.int64()))
    t = t.sort_by("pos")
    pieces, begin = _of_rows(t)
    count = len(begin) - 1
    conv = t.column("conv").combine_chunks().take(pa.array(begin[:-1]))
    after = {c: (x, e) for c, x, e in zip(told.column("conv").to_pylist(), told.column("after").to_pylist(),
                                          told.column("ends").to_pylist(), strict=True)}
    exits = np.array([after[c][0] for c in conv.to_pylist()], np.int64)
    ends = np.array([after[c][1] for c in conv.to_pylist()], bool)
    cost = pieces.costs(exits)
    which, state = np.repeat(np.arange(count), STATES), np.tile(np.arange(STATES), count)
    (who, row, edit, role), audit, last = pieces.edits(cost, ends, which, state)
    pos, seg = t.column("pos").to_numpy(), t.column("seg")[0].as_py()
    facts = _table(kinds, seg=[seg] * len(which), conv=conv.take(pa.array(which)), state=state, exit=last, audit=audit)
    made = _table(kinds, seg=[seg] * len(row), conv=conv.take(pa.array(which[who])), state=state[who], pos=pos[row],
                  edit=edit, role=role)
    return pa.concat_tables([facts, made])


# ------------------------------------------------------------ chains of pieces

def _doubled(pieces: DataFrame, col: str, combine, ahead: bool, rounds: int) -> DataFrame:
    """Running products over a conversation's pieces: after ``rounds`` joins
    at distances 1, 2, 4, ... ``col`` combines a piece with all pieces after it
    (``ahead``) or before it."""
    now = pieces
    for r in range(rounds):
        far = now.select(F.col("conv").alias("c2"), (F.col("seg") + (-(1 << r) if ahead else 1 << r)).alias("s2"),
                         F.col(col).alias("other"))
        both = now.join(far, (F.col("seg") == F.col("s2")) & F.col("conv").eqNullSafe(F.col("c2")), "left")
        now = written(both.withColumn(col, F.when(F.col("other").isNull(), F.col(col)).otherwise(
            combine(F.col(col), F.col("other")))).drop("c2", "s2", "other"), "doubled")
    return now


def _product(a, b):
    """Cheapest costs over two pieces, one after the other."""
    return F.array(*[F.least(*[F.get(a, F.lit(STATES * s + m)) + F.get(b, F.lit(STATES * m + t))
                               for m in range(STATES)], F.lit(FAR)) for s in range(STATES) for t in range(STATES)])


def _then(later, earlier):
    """The states after two pieces by the state before the first of them."""
    return F.transform(earlier, lambda s: F.get(later, s))


def _crossing(facts: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(edits, ``seg, conv, audit, cost``) of conversations over several
    segments; ``None`` where there are none."""
    pieces = facts.filter("not whole").select("seg", "conv", "matrix")
    chains = pieces.groupBy("conv").agg(F.min("seg").alias("first"), F.max("seg").alias("last"))
    longest = chains.agg(F.max(F.col("last") - F.col("first") + 1)).first()[0]
    if longest is None:
        return None
    rounds = max(0, int(longest - 1).bit_length())
    on = F.col("conv").eqNullSafe(F.col("c2"))
    pieces = written(pieces.join(chains.withColumnRenamed("conv", "c2"), on).drop("c2"), "pieces")
    to_end = _doubled(pieces, "matrix", _product, True, rounds)
    cost = F.array(*[F.least(*[F.get("matrix", F.lit(STATES * s + t)) + F.lit(int(END[t])) for t in range(STATES)])
                     for s in range(STATES)])
    to_end = to_end.select("seg", "conv", "first", "last", cost.alias("cost"))
    # each piece with the costs after it
    follow = to_end.select((F.col("seg") - 1).alias("s2"), F.col("conv").alias("c2"), F.col("cost").alias("after"))
    told = (to_end.join(follow, (F.col("seg") == F.col("s2")) & on, "left")
            .select("seg", "conv", F.coalesce("after", F.array(*[F.lit(int(x)) for x in END])).alias("after"),
                    (F.col("seg") == F.col("last")).alias("ends")))
    mine = pieces.select(F.col("seg").alias("s2"), F.col("conv").alias("c2"))
    some = rows.join(mine, (F.col("seg") == F.col("s2")) & on, "left_semi")
    schema = _OUT.format(conv=dict(rows.dtypes)["conv"])
    both = written(some.groupBy("seg").cogroup(told.groupBy("seg")).applyInArrow(
        lambda t, u: _second_pass(t, u), schema), "crossing")
    maps = (both.filter("pos is null").groupBy("seg", "conv")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("state", "exit"))), lambda x: x["exit"]).alias("map")))
    walked = _doubled(written(maps, "maps"), "map", _then, False, rounds)
    came = walked.select((F.col("seg") + 1).alias("s2"), F.col("conv").alias("c2"), F.get("map", F.lit(0)).alias("enters"))
    start = (pieces.join(came, (F.col("seg") == F.col("s2")) & on, "left")
             .select(F.col("seg").alias("s3"), F.col("conv").alias("c3"),
                     F.when(F.col("seg") == F.col("first"), 0).otherwise(F.col("enters")).alias("enters")))
    chosen = both.join(start, (F.col("seg") == F.col("s3")) & F.col("conv").eqNullSafe(F.col("c3"))
                       & (F.col("state") == F.col("enters"))).drop("s3", "c3", "enters")
    price = (to_end.filter("seg = first").select(F.col("seg").alias("s2"), F.col("conv").alias("c2"),
                                                 F.get("cost", F.lit(0)).alias("price")))
    audits = (chosen.filter("pos is null").select("seg", "conv", "audit")
              .join(price, (F.col("seg") == F.col("s2")) & on, "left")
              .select("seg", "conv", "audit", F.col("price").alias("cost")))
    return chosen.filter("pos is not null").select("conv", "pos", "edit", F.col("role").alias("becomes")), audits


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """(rows, summary) of conversations.

    Rows: ``conv, pos, turn, role, text`` (before repair) with ``edit``, the
    edits at this row in order, and ``becomes``, a sign for each of them: u or
    a for an inserted or renamed turn's role, = for a row that is kept, - for
    one that is deleted. See ``repaired`` for the repaired rows.

    Summary: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``,
    one row per conversation that has rows.

    Defined cases: a null role or text is one space (a blank row has to be
    deleted, a role of no known initial renamed or deleted); a null turn comes
    first and is none of the turns; a null conversation id is a conversation of
    its own; rows of one turn come in the order of the hash of role and text;
    equal rows are duplicates of the first; an empty table gives empty tables.
    Texts never enter the search, so their length plays no part in it.
    """
    importable(rows.sparkSession)
    src = rows.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
                      F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text"))
    whole = numbered(faults(src))
    # the first of equal rows by its place, a unique key: no hot group is joined
    first = whole.groupBy("conv", "h").agg(F.min("pos").alias("pos")).select("pos", F.lit(False).alias("again"))
    small = (whole.select("conv", "pos", "turn", "initial", "blank", "cut").join(first, "pos", "left")
             .withColumn("again", F.coalesce("again", F.lit(True)))
             .withColumn("seg", F.floor(F.col("pos") / segment)))
    small = written(small, "small")
    place = F.col("pos") % segment
    lent = small.withColumn("lent", F.lit(False)).unionByName(
        small.filter(place == segment - 1).withColumns({"seg": F.col("seg") + 1, "lent": F.lit(True)})).unionByName(
        small.filter((place == 0) & (F.col("seg") > 0)).withColumns({"seg": F.col("seg") - 1, "lent": F.lit(True)}))
    # a row lent to a segment that has none of its own is nobody's
    last = small.agg(F.max("seg")).scalar()
    schema = _OUT.format(conv=dict(small.dtypes)["conv"])
    found = written(lent.filter(F.col("seg") <= last).groupBy("seg").applyInArrow(
        lambda t: _first_pass(t), schema), "segments")
    facts, edits = found.filter("pos is null"), found.filter("pos is not null").select(
        "conv", "pos", "edit", F.col("role").alias("becomes"))
    more = _crossing(facts, small)
    audits = facts.filter("whole").select("seg", "conv", "audit", "cost")
    if more is not None:
        edits, audits = edits.unionByName(more[0]), audits.unionByName(more[1])
    counts = facts.groupBy("conv").agg(
        (F.coalesce(F.max("high") - F.min("low") + 1, F.lit(0))).alias("span"), F.sum("turns").alias("turns"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    # the distinct turns of pieces add up: a turn is counted where it is fresh
    texts = audits.groupBy(F.col("conv").alias("c2")).agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    summary = (counts.join(texts, F.col("conv").eqNullSafe(F.col("c2")))
               .select("conv", (F.col("span") - F.col("turns")).alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                       "cost", "audit"))
    joined = whole.select("conv", "pos", "turn", "role", "text").join(edits.drop("conv"), "pos")
    return joined, summary


def repaired(rows: DataFrame) -> DataFrame:
    """``conv, pos, nth, role, text``: the repaired rows of ``repair``; inserted
    turns have an empty text. ``nth`` orders the turns made at one row."""
    sign = F.substring("becomes", F.col("nth") + 1, F.lit(1))
    each = rows.withColumn("nth", F.explode(F.sequence(F.lit(0), F.length("edit") - 1))).withColumns(
        {"letter": F.substring("edit", F.col("nth") + 1, F.lit(1)), "sign": sign})
    role = F.when(F.col("sign") == "=", F.col("role")).when(F.col("sign") == "u", ROLES["u"]).otherwise(ROLES["a"])
    return (each.filter("letter <> 'D'")
            .select("conv", "pos", "nth", role.alias("role"),
                    F.when(F.col("letter") == "I", "").otherwise(F.col("text")).alias("text")))


def digests(turns: DataFrame) -> DataFrame:
    """``conv, sha256`` of each conversation's ``role:text`` lines. A digest is
    one stream of bytes, so a conversation's turns pass one task in order, in
    batches; nothing of them is held."""
    lines = turns.select("conv", "pos", "nth", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("conv").sortWithinPartitions("conv", "pos", "nth").select("conv", "line")
    conv = dict(lines.dtypes)["conv"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            names, made, kind = batch.column(0).to_pylist(), [], batch.column(0).type
            for c, line in zip(names, batch.column(1), strict=True):
                if state is None or c != now:
                    if state is not None:
                        made.append((now, state.hexdigest()))
                    now, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], kind),
                                              pa.array([m[1] for m in made], pa.string())], names=["conv", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([state.hexdigest()], pa.string())],
                                             names=["conv", "sha256"])
    return lines.mapInArrow(run, f"conv {conv}, sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` damaged by the CRC-32 of ``conv_id:turn``
    modulo 20 (nulls are one space): 0 drops the row, 1 empties its text, 2
    removes its full stops, exclamation and question marks, 3 repeats it, 4
    sets its role to user."""
    def told(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text, role = told("text"), told("role")
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    return (marked.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1)))
                                                .otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text")))


def q_conversations(spark, sf_dir: str) -> DataFrame:
    src = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows, summary = repair(damaged(src))
    names = src.select("conv_id").distinct()
    sha = digests(repaired(rows)).withColumnRenamed("conv", "c3")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    none = hashlib.sha256(b"").hexdigest()
    return (names.join(summary, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
            .join(sha, F.col("conv_id").eqNullSafe(F.col("c3")), "left")
            .select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha256", F.lit(none)).alias("repaired_sha256")))


# CRC-32 by bits; a forward search keeps the least (cost, audit) by state and
# row: up to a row, audits end with as many D, K, R, so none begins another.
SQL = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
keyed AS (
  SELECT *, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           string_split(name, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b),
           [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT) + y))) % 20 AS kind
  FROM src),
dam AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM keyed WHERE kind <> 0)),
num AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS i
  FROM dam),
f0 AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open, role[1:1] AS ini,
         lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM num),
f AS (SELECT *, CASE WHEN blank THEN 'b' WHEN again THEN 'd' WHEN open THEN 't' ELSE '' END AS fault FROM f0),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (i > 1 AND (prev || ini) NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
-- states: 0 nothing yet, 1 after s, 2 after u, 3 after a
ins(state, extra, audit, roles, next) AS (VALUES
  (0, 0, '', '', 0), (0, 2, 'I', 'u', 2), (0, 4, 'II', 'ua', 3), (1, 0, '', '', 1), (1, 2, 'I', 'u', 2), (1, 4, 'II', 'ua', 3),
  (2, 0, '', '', 2), (2, 2, 'I', 'a', 3), (3, 0, '', '', 3), (3, 2, 'I', 'u', 2)),
keep(ini, state, next) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
due(state, role, next) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
step AS (  -- one row from state to state, turns inserted before it
  SELECT f.conv_id, f.i, ins.state AS a, x.next AS b, ins.extra + x.cost AS cost, ins.audit || x.letter AS audit,
         list_concat(list_transform(string_split(ins.roles, ''), lambda c: CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END)[1:length(ins.roles)],
                     x.line) AS lines
  FROM f, ins, LATERAL (
    SELECT 'D' AS letter, 3 AS cost, ins.next AS next, []::VARCHAR[] AS line
    UNION ALL SELECT 'K', (f.fault = 't')::INT, k.next, [f.role || ':' || f.text] FROM keep k
              WHERE k.ini = f.ini AND k.state = ins.next AND f.fault NOT IN ('b', 'd')
    UNION ALL SELECT 'R', 2 + (f.fault = 't')::INT, d.next, [d.role || ':' || f.text] FROM due d
              WHERE d.state = ins.next AND f.fault NOT IN ('b', 'd')) x),
best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM facts
  UNION ALL
  SELECT conv_id, i, state, p.cost, p.audit, p.lines FROM (
    SELECT q.conv_id, s.i, s.b AS state,
           min({'cost': q.cost + s.cost, 'audit': q.audit || s.audit, 'lines': list_concat(q.lines, s.lines)}) AS p
    FROM best q JOIN step s ON s.conv_id IS NOT DISTINCT FROM q.conv_id AND s.i = q.i + 1 AND s.a = q.state
    GROUP BY ALL)),
done AS (
  SELECT b.conv_id, min({'cost': b.cost + ins.extra, 'audit': b.audit || ins.audit, 'lines': list_concat(b.lines,
         list_transform(string_split(ins.roles, ''), lambda c: CASE c WHEN 'u' THEN 'user:' ELSE 'assistant:' END)[1:length(ins.roles)])}) AS p
  FROM best b JOIN facts ON facts.conv_id IS NOT DISTINCT FROM b.conv_id AND facts.n = b.i
  JOIN ins ON ins.state = b.state AND ins.next IN (0, 3) GROUP BY b.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(p.cost, 0)::BIGINT AS cost, coalesce(p.audit, '') AS audit,
       sha256(coalesce(array_to_string(p.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id
"""
