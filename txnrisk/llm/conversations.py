"""Repair of the turn structure of conversations by the cheapest edits.

A repaired conversation has the roles ``(system? (user assistant)+)?``. Every row is a symbol: the
initial of its role and its fault. Rows are dealt by ranges of (conversation, turn), so that a
conversation with a third of all rows lies in many ranges; a range's stretch of a conversation is a
piece, which travels as one byte per row. The edits of a conversation are found on its symbols alone:

* equal symbols in a row are collapsed to runs. What a row can do to the state of the pattern and at
  what cost is a 4 x 4 matrix over (min, +); a run applies its matrix's binary powers, which are kept;
* from the end to the start this gives the cost to go behind every run. The choices are then unrolled
  from the start, halving runs down to single rows, always taking the first letter that costs no more.

The edits go back to the pieces, and the rows with their texts are edited range by range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.llm.common import by_value, join_facts, partitions, schema_of, stage

SPACES = " \t\n\x0b\x0c\r"
#: Costs of the edits; an undeleted truncated row adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Classes of role initials, in the order of their numbers; any other initial is class 3.
INITIALS = "sua"
OTHER = 3
OK, BLANK, DUPLICATE, CUT = range(4)
NAMES = {"u": "user", "a": "assistant"}
#: Bytes of text in a range.
RANGE_BYTES = 16 << 20
#: Bytes of a conversation's text that are sent on at a time if it lies in several ranges.
CHUNK_BYTES = 1 << 20
_FAR = 1 << 60

# The pattern's states: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn.
_FOLLOW = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_END = (0, 2 * INSERT, INSERT, 0)


def _insert(state: int) -> tuple[str, int]:
    """The only role that can be inserted in a state, and the state after it."""
    letter = "a" if state == 2 else "u"
    return letter, _FOLLOW[state][letter]


def _choices(symbol: int, state: int) -> list[tuple[str, str, int, int]]:
    """(edit, role letter afterwards, cost, state) for a row, in order of the edits' letters."""
    kind, fault = symbol % 4, symbol // 4
    out = [("D", "-", DELETE, state)]
    if fault in (OK, CUT):
        extra = TRUNCATED if fault == CUT else 0
        for letter, after in _FOLLOW[state].items():
            if kind != OTHER and INITIALS[kind] == letter:
                out.append(("K", "k", extra, after))
        for letter, after in _FOLLOW[state].items():
            if letter in NAMES:
                out.append(("R", letter, REROLE + extra, after))
    return out


class Transitions:
    """The matrices of the symbols, their binary powers and the choices met so far.

    Costs to go differ between states by a bounded amount, so up to a constant there are few
    vectors, and both caches stay small.
    """

    def __init__(self):
        self.powers: dict[int, list[list[list[int]]]] = {}
        self.steps: dict[tuple, tuple] = {}

    def _matrix(self, symbol: int) -> list[list[int]]:
        row = [[_FAR] * 4 for _ in range(4)]
        for state in range(4):
            for _, _, cost, after in _choices(symbol, state):
                row[state][after] = min(row[state][after], cost)
        out = [list(r) for r in row]
        for state in range(4):  # any turns inserted before the row; three would come back to a state
            cost, at = 0, state
            for _ in range(2):
                at = _insert(at)[1]
                cost += INSERT
                out[state] = [min(a, cost + b) for a, b in zip(out[state], row[at])]
        return out

    def power(self, symbol: int, k: int) -> list[list[int]]:
        """The matrix of 2^k rows with the same symbol."""
        known = self.powers.setdefault(symbol, [])
        while len(known) <= k:
            if not known:
                known.append(self._matrix(symbol))
                continue
            m = known[-1]
            known.append([[min(m[s][i] + m[i][t] for i in range(4)) for t in range(4)] for s in range(4)])
        return known[k]

    def before(self, symbol: int, n: int, after: tuple[int, ...]) -> tuple[int, ...]:
        """Cost to go before n equal rows, from that behind them."""
        k = 0
        while n:
            if n & 1:
                m = self.power(symbol, k)
                after = tuple(min(a + b for a, b in zip(m[s], after)) for s in range(4))
            n >>= 1
            k += 1
        return after

    def choose(self, symbol: int, after: tuple[int, ...], state: int) -> tuple[str, str, int]:
        """Edits of a row and the roles they give: of the cheapest, the first by letters."""
        least = min(after)
        key = symbol, state, tuple(x - least for x in after)
        found = self.steps.get(key)
        if found is None:
            go = self.before(symbol, 1, after)
            edits, roles, at = "", "", state
            while True:
                taken = next((c for c in _choices(symbol, at) if c[2] + after[c[3]] == go[at]), None)
                letter, following = _insert(at)
                inserts = INSERT + go[following] == go[at]
                if taken is not None and not (inserts and taken[0] > "I"):
                    break
                edits, roles, at = edits + "I", roles + letter, following
            found = self.steps[key] = edits + taken[0], roles + taken[1], taken[3]
        return found

    def solve(self, symbols: bytes) -> tuple[int, list[str], list[str]]:
        """The least cost, and per row its edits (turns inserted before it first) and their roles.

        Turns inserted at the end are the last row's.
        """
        array = np.frombuffer(symbols, np.uint8)
        cuts = np.flatnonzero(np.diff(array)) + 1
        begin = np.concatenate([[0], cuts]).tolist()
        sizes = np.diff(np.append(begin, len(array))).tolist()
        runs = [(symbols[b], n) for b, n in zip(begin, sizes)]
        behind = [_END]
        for symbol, n in reversed(runs):
            behind.append(self.before(symbol, n, behind[-1]))
        cost = behind.pop()[0]
        edits: list[str] = []
        roles: list[str] = []
        state = 0
        for symbol, n in runs:
            todo = [(n, behind.pop())]
            while todo:
                n, after = todo.pop()
                if n == 1:
                    e, r, state = self.choose(symbol, after, state)
                    edits.append(e)
                    roles.append(r)
                else:
                    half = n // 2
                    todo += [(n - half, after), (half, self.before(symbol, n - half, after))]
        while state in (1, 2):
            letter, state = _insert(state)
            edits[-1] += "I"
            roles[-1] += letter
        return cost, edits, roles


@dataclass
class Repair:
    """``audits``: a row per conversation; ``repaired``: its turns, in order of ``place``."""

    audits: DataFrame
    repaired: DataFrame


def _ordered(rows: DataFrame, conv: str, turn: str) -> DataFrame:
    """The rows in ranges, with what their symbols need; ``at`` is their global order."""
    spark = rows.sparkSession
    role, text = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    taken = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), role, text)
    total = taken.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    taken = taken.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = ["conv", "turn", "role", "tie", "row"]
    dealt = taken.repartitionByRange(partitions(spark, total, RANGE_BYTES), *order).sortWithinPartitions(*order)
    of = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    same = F.concat_ws(":", F.length(of).cast("string"), of, F.length("role").cast("string"), "role", "text")
    at = F.monotonically_increasing_id()
    dealt = dealt.select("conv", "turn", "role", "text", at.alias("at"), F.md5(same).alias("same"), last.alias("last"))
    kind = F.coalesce(F.nullif(F.instr(F.lit(INITIALS), F.substring("role", 1, 1)), F.lit(0)) - 1, F.lit(OTHER))
    kind = F.when(F.length("role") > 0, kind).otherwise(OTHER)
    dealt = dealt.withColumns({"part": F.shiftright("at", 33), "kind": kind.cast("int")})
    return stage(dealt, "conversation-rows")


def _symbols(rows: DataFrame) -> DataFrame:
    """(part, at, conv, turn, symbol): the first fault counts; texts are not read again."""
    narrow = rows.select("part", "at", "conv", "turn", "kind", "same", "last")
    again = narrow.groupBy("same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = stage(again.select("same", "first"), "repeated-turns")
    marked = join_facts(narrow, again, "same", F.col("at"))
    fault = (
        F.when(F.col("last") == "", BLANK)
        .when(F.col("at") > F.col("first"), DUPLICATE)
        .when(~F.col("last").isin(".", "!", "?"), CUT)
        .otherwise(OK)
    )
    return marked.select("part", "at", "conv", "turn", (F.col("kind") + 4 * fault).cast("int").alias("symbol"))


#: A piece; what holds for the whole conversation stands with its last piece.
_PIECE = (
    "part long, first long, whole boolean, symbols binary, low long, high long, turns long, edits string, roles string, "
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def _settle(pieces: list[dict], moves: Transitions) -> list[dict]:
    """The edits of one conversation, whose pieces come in order."""
    symbols = b"".join(p["symbols"] for p in pieces)
    cost, edits, roles = moves.solve(symbols)
    at = 0
    for p in pieces:
        n = len(p["symbols"])
        p["edits"], p["roles"] = "".join(edits[at : at + n]), "".join(roles[at : at + n])
        p["symbols"] = None
        at += n
    array = np.frombuffer(symbols, np.uint8)
    kind, fault = array % 4, array // 4
    pair = kind[:-1] * 4 + kind[1:]
    legal = [INITIALS.index(a) * 4 + INITIALS.index(b) for a, b in ("su", "ua", "au")]
    dated = [p for p in pieces if p["turns"]]
    gaps = 0
    if dated:
        shared = sum(a["high"] == b["low"] for a, b in zip(dated, dated[1:]))
        gaps = dated[-1]["high"] - dated[0]["low"] + 1 - sum(p["turns"] for p in dated) + shared
    pieces[-1] |= {
        "gaps": min(gaps, (1 << 63) - 1), "blank": int((fault == BLANK).sum()), "duplicate": int((fault == DUPLICATE).sum()),
        "truncated": int((fault == CUT).sum()), "illegal": int((~np.isin(pair, legal)).sum()), "cost": cost,
        "audit": "".join(edits),
    }
    return pieces


def _pieces(symbols: DataFrame) -> DataFrame:
    """All pieces with their edits.

    A conversation inside a range is settled there. The first and the last of a range may go on in
    others: their pieces, two per range, meet in a second step, at a byte per row, which is what a row
    of the audit takes in the result as well.
    """
    kinds = T.StructType([T.StructField("conv", symbols.schema["conv"].dataType), *schema_of(_PIECE).fields])
    empty = dict.fromkeys(kinds.fieldNames())

    def cut(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        table = table.sort_by("at")
        conv = table.column("conv").combine_chunks().dictionary_encode("encode")
        which = conv.indices.to_numpy(zero_copy_only=False)
        codes = table.column("symbol").to_numpy().astype(np.uint8)
        turn = table.column("turn").combine_chunks()
        known, turns = turn.is_valid().to_numpy(zero_copy_only=False), turn.fill_null(0).to_numpy()
        first, names = table.column("at").to_numpy(), conv.dictionary.to_pylist()
        begin = np.concatenate([[0], np.flatnonzero(np.diff(which)) + 1]).tolist()
        moves, out = Transitions(), []
        for b, e in zip(begin, [*begin[1:], len(which)]):
            own = turns[b:e][known[b:e]]
            piece = empty | {
                "conv": names[which[b]], "part": int(first[b]) >> 33, "first": int(first[b]), "whole": b > 0 and e < len(which),
                "symbols": codes[b:e].tobytes(), "turns": 1 + int((np.diff(own) != 0).sum()) if len(own) else 0,
            }
            if len(own):
                piece |= {"low": int(own[0]), "high": int(own[-1])}
            out += _settle([piece], moves) if piece["whole"] else [piece]
        return pa.Table.from_pylist(out, schema=to_arrow_schema(kinds))

    def join(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        pieces = _settle(table.sort_by("first").to_pylist(), Transitions())
        return pa.Table.from_pylist(pieces, schema=to_arrow_schema(kinds))

    found = stage(symbols.groupBy("part").applyInArrow(cut, kinds), "conversation-pieces")
    ends = found.filter(~F.col("whole")).groupBy("conv").applyInArrow(join, kinds)
    return stage(found.filter("whole").unionByName(ends), "conversation-edits")


def _edited(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """The rows after their pieces' edits: (conv, place, whole, edit, turn, role, text)."""
    kinds = T.StructType(
        [rows.schema["conv"], *schema_of("place long, whole boolean, edit string, turn long, role string, text string").fields]
    )

    def apply(table: pa.Table, edits: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        table = table.sort_by("at")
        conv, turn, role, text = (table.column(c) for c in ("conv", "turn", "role", "text"))
        take: list[int | None] = []
        out: dict[str, list] = {c: [] for c in ("conv", "place", "whole", "edit", "role")}
        row = step = 0
        for piece in edits.sort_by("first").to_pylist():
            for edit, letter in zip(piece["edits"], piece["roles"]):
                if edit != "D":
                    take.append(None if edit == "I" else row)
                    out["conv"].append(piece["conv"])
                    out["place"].append((piece["part"] << 33) + step)
                    out["whole"].append(piece["whole"])
                    out["edit"].append(edit)
                    out["role"].append(role[row].as_py() if edit == "K" else NAMES[letter])
                row += edit != "I"
                step += 1
        at = pa.array(take, pa.int64())
        columns = out | {"turn": turn.take(at), "text": text.take(at).fill_null("")}
        schema = to_arrow_schema(kinds)
        return pa.table([pa.chunked_array(x.chunks, f.type) if isinstance(x := columns[f.name], pa.ChunkedArray) else pa.array(x, f.type) for f in schema], schema=schema)

    wanted = pieces.select("conv", "part", "first", "whole", "edits", "roles")
    texts = rows.select("part", "at", "conv", "turn", "role", "text")
    return texts.groupBy("part").cogroup(wanted.groupBy("part")).applyInArrow(apply, kinds)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> Repair:
    """Check and repair all conversations of a table with columns (conv, turn, role, text).

    A conversation's rows count in order of the turn, null turns first; rows of one turn in order of role
    and of a hash of the text, so that equal ones are neighbours. Null roles and texts are one space; rows
    without a conversation form one. Other columns are ignored. An empty table gives empty results.

    ``audits`` has (conv, gaps, blank, duplicate, truncated, illegal, cost, audit); ``repaired`` has
    (conv, place, whole, edit, turn, role, text), inserted turns without a turn and with an empty text;
    ``whole`` tells that the conversation lies within one range.
    """
    ordered = _ordered(rows, conv, turn)
    pieces = _pieces(_symbols(ordered))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    audits = pieces.filter(F.col("cost").isNotNull()).select(F.col("conv").alias(conv), *counts)
    edited = _edited(ordered, pieces)
    return Repair(audits, edited.select(F.col("conv").alias(conv), *[c for c in edited.columns if c != "conv"]))


def digests(repaired: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, sha256): of the lines ``role:text`` of each conversation with any turn, joined by newlines.

    Takes ``Repair.repaired`` as it is: what lies within a range is hashed where it was edited, as it
    streams by. Only the others are sent on, in chunks, and are hashed one after the other.
    """
    kinds = T.StructType([repaired.schema[conv], *schema_of("place long, sha256 string, chunk binary").fields])
    names = kinds.fieldNames()

    def lines(batches) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in (conv, "place", "whole", "role", "text")))

    def emit(out: list[tuple]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], names)

    def by_range(batches):
        out: list[tuple] = []
        now, sha, chunk, size = None, None, [], 0

        def close() -> None:
            if now is not None:
                out.append((now[0], now[2], sha.hexdigest(), None) if now[3] else (now[0], now[2], None, b"\n".join(chunk)))

        for key, place, whole, role, text in lines(batches):
            line = f"{role}:{text}".encode()
            if now is None or (key, place >> 33) != now[:2] or (not whole and size > CHUNK_BYTES):
                close()
                now, sha, chunk, size = (key, place >> 33, place, whole), hashlib.sha256(), [], 0
                sha.update(line)
            else:
                sha.update(b"\n" + line)
            if not whole:
                chunk.append(line)
                size += len(line)
            if len(out) >= 1000:
                yield emit(out)
                out = []
        close()
        if out:
            yield emit(out)

    def in_turn(batches):
        now, sha, begun = None, None, False
        for batch in batches:
            out = []
            for key, chunk in zip(batch.column(conv).to_pylist(), batch.column("chunk").to_pylist()):
                if not begun or key != now:
                    if begun:
                        out.append((now, 0, sha.hexdigest(), None))
                    now, sha, begun = key, hashlib.sha256(chunk), True
                else:
                    sha.update(b"\n" + chunk)
            if out:
                yield emit(out)
        if begun:
            yield emit([(now, 0, sha.hexdigest(), None)])

    parts = stage(repaired.mapInArrow(by_range, kinds), "conversation-digests")
    split = parts.filter(F.col("sha256").isNull())
    chained = split.repartition(conv).sortWithinPartitions(conv, "place").mapInArrow(in_turn, kinds)
    return parts.filter(F.col("sha256").isNotNull()).unionByName(chained).select(conv, "sha256")


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, turn, role, text) with faults by a hash of conversation and turn: of 20 rows on average one is
    dropped, one emptied, one loses its sentence ends, one is repeated, one gets the role of the user.

    Nulls are one space in the hash, and null roles and texts become one space.
    """

    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(known(conv), F.lit(":"), known(turn)).cast("binary")) % 20
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace(known("text"), "[.!?]", ""))
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    marked = rows.select(conv, turn, "role", "text", fault.alias("_fault")).filter("_fault <> 0")
    return marked.select(
        conv, turn, F.when(F.col("_fault") == 4, "user").otherwise(known("role")).alias("role"),
        text.otherwise(known("text")).alias("text"), F.explode(copies).alias("_copy"),
    ).drop("_copy")


by_value(__name__)
