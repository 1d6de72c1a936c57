"""Repair of the turn structure of conversations by cheapest edits, with dynamic programming shared over a prefix trie.

What the cheapest edits are depends on a conversation's signature only: per turn, the role's initial and whether it must go or
is cut off.  Signatures are made without gathering a conversation: its turns are dealt by ranges of (conversation, turn), each
range gives the piece of a signature, and pieces are strung together.  Within a task, sorted signatures are the paths of a
prefix trie in order, so that each layer of the dynamic programme is made once per shared prefix and a conversation's answer is read off
where its path ends.  The edits then meet the turns once more, as a sorted stream.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafpress.storage import materialize

#: ASCII white space; marks that end a turn's text; role initials and the adjacent ones that are in order.
BLANKS, ENDS, INITIALS, IN_ORDER = "\x20\x09\x0a\x0b\x0c\x0d", (".", "!", "?"), "sua", ("su", "ua", "au")
#: What edits cost, and what keeping a turn costs whose text is cut off.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: States of a repaired beginning: nothing yet, a system turn, a user turn last, an assistant turn last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn with the role that must come next, and that role.
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: States that a turn with its own role may follow, and the state behind it.
FOLLOWS = {"s": ((EMPTY,), SYSTEM), "u": ((EMPTY, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}

Layer = tuple[tuple[int, int] | None, ...]
START: Layer = ((0, 0), None, None, None)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with planted faults, by a checksum of id and turn modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's.  Nulls in role and text, and in
    what the checksum is of, are one space.  Other columns are ignored.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.expr("if(kind = 3, array(0, 1), array(0))")))
    return rows.drop("col")


def _digest() -> Column:
    """Tells role and text apart from all others, and orders different rows of one turn."""
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


def _filled(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))


def signatures(turns: DataFrame) -> DataFrame:
    """Per conversation: signature, and counts of gaps, blank, duplicate, truncated and illegally adjacent turns.

    A signature has a letter a turn: its initial (``x`` for others), upper case if its text is cut off, or ``d`` if it must go.
    """
    trimmed = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(trimmed == "", "b").when(~F.substring(trimmed, -1, 1).isin(*ENDS), "t").otherwise("")
    rows = _filled(turns).select("conv_id", "turn", _digest().alias("h"), F.when(initial.isin(*INITIALS), initial).otherwise("x").alias("role"), kind.alias("kind"))
    # Equal rows of a turn become one with their number, whatever their number is
    rows = materialize(rows.groupBy("conv_id", "turn", "h").agg(F.first("role").alias("role"), F.first("kind").alias("kind"), F.count("*").alias("n")), "turns")
    first = rows.groupBy("conv_id", "h").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("first"))
    rows = rows.alias("r").join(first.alias("f"), F.expr("r.conv_id <=> f.conv_id and r.h = f.h")).select("r.*", F.expr("r.turn <=> f.first.turn").alias("new"))
    rows = materialize(rows, "marked").repartitionByRange("conv_id", "turn", "h").sortWithinPartitions("conv_id", "turn", "h")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = _runs(batch.column("conv_id"))
            columns = {c: batch.column(c).to_pylist() for c in ("turn", "h", "role", "kind", "n", "new")}
            pieces = [_piece({c: x[a:b] for c, x in columns.items()}) for a, b in runs]
            ids = batch.column("conv_id").take(pa.array([a for a, _ in runs], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([p[k] for p in pieces], kind) for k, (_, kind) in enumerate(_PIECE))], ["conv_id", *(c for c, _ in _PIECE)])

    kind_of_id = turns.schema["conv_id"].dataType.simpleString()
    named = {pa.bool_(): "boolean", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    pieces = rows.mapInArrow(cut, f"conv_id {kind_of_id}, " + ", ".join(f"{c} {named[kind]}" for c, kind in _PIECE))
    joined = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*(c for c in pieces.columns if c != "conv_id")))).alias("p"))
    total = lambda c: f"aggregate(p, 0L, (s, x) -> s + x.{c})"
    seams = "if(size(p) < 2, array(), sequence(1, size(p) - 1))"
    legal = ", ".join(f"'{x}'" for x in IN_ORDER)
    shared = f"size(filter({seams}, i -> p[i].turn = p[i - 1].last_turn))"
    wide = "cast(array_max(p.most) as decimal(38, 0)) - array_min(p.least) + 1"
    return joined.selectExpr(
        "conv_id",
        "array_join(p.signature, '') as signature",
        f"coalesce(try_cast({wide} - {total('turns')} + {shared} as bigint), 0L) as gaps",
        *(f"{total(c)} as {c}" for c in ("blank", "duplicate", "truncated")),
        f"{total('illegal')} + size(filter({seams}, i -> concat(p[i - 1].tail, p[i].head) not in ({legal}))) as illegal",
    )


def _runs(column: pa.Array) -> list[tuple[int, int]]:
    """Where equal neighbours (null equals null) begin and end."""
    if not len(column):
        return []
    codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
    return list(zip(cuts, cuts[1:], strict=False))


#: A piece: the place of its first turn in order, its letters, its outer roles, what its turns span, and counts.
_PIECE = [("some", pa.bool_()), ("turn", pa.int64()), ("h", pa.binary()), *((c, pa.string()) for c in ("signature", "head", "tail")), *((c, pa.int64()) for c in ("least", "most", "last_turn", "blank", "duplicate", "truncated", "illegal", "turns"))]


def _piece(rows: dict[str, list]) -> list:
    """What one run of a conversation's sorted turns adds to its signature and counts."""
    letters, roles, blank, duplicate, truncated = [], [], 0, 0, 0
    for role, kind, n, new in zip(rows["role"], rows["kind"], rows["n"], rows["new"], strict=True):
        roles.append(role * n)
        if kind == "b":
            letters.append("d" * n)
            blank += n
            continue
        letters.append((role.upper() if kind else role) * new + "d" * (n - new))
        truncated += bool(new and kind)
        duplicate += n - new
    spelt, turns = "".join(roles), rows["turn"]
    own = {t for t in turns if t is not None}
    illegal = sum(spelt[i : i + 2] not in IN_ORDER for i in range(len(spelt) - 1))
    return [turns[0] is not None, turns[0], rows["h"][0], "".join(letters), spelt[0], spelt[-1], min(own, default=None), max(own, default=None), turns[-1], blank, duplicate, truncated, illegal, len(own)]


def _with_inserts(layer: Layer) -> Iterator[tuple[int, int, int, int]]:
    """(state, cost, state before inserting, inserted turns): more than two never pay."""
    for origin, held in enumerate(layer):
        if held is not None:
            state, cost = origin, held[0]
            for n in range(3):
                yield state, cost, origin, n
                state, cost = NEXT[state], cost + INSERT


@lru_cache(maxsize=4096)
def step(layer: Layer, letter: str) -> tuple[Layer, int, tuple]:
    """The next layer with costs from its least one on, that cost, and per state (state before, inserted turns, edit).

    A layer holds per state the least cost and the place of its edits among those of all states in ASCII order.  Edits of different states end
    with an edit of the same turn, so none is the beginning of another and their order outlasts whatever follows.
    """
    best: list[tuple[int, int, str, int, int, str] | None] = [None] * 4
    for state, cost, origin, n in _with_inserts(layer):
        moves = [(state, "D", DELETE)]
        if letter != "d":
            cut_off = CUT_OFF * letter.isupper()
            after, then = FOLLOWS.get(letter.lower(), ((), EMPTY))
            moves += [(then, "K", cut_off)] * (state in after) + [(NEXT[state], "R", REROLE + cut_off)]
        for to, edit, price in moves:
            found = (cost + price, layer[origin][1], "I" * n + edit, origin, n, edit)
            if best[to] is None or found < best[to]:
                best[to] = found
    least = min(b[0] for b in best if b)
    order = sorted(b[1:3] for b in best if b)
    return tuple(b and (b[0] - least, order.index(b[1:3])) for b in best), least, tuple(b and b[3:] for b in best)


class Trie:
    """The path from the root to the signature asked last; a layer stays as long as signatures in sorted order share it."""

    def __init__(self) -> None:
        self.signature = ""
        self.layers, self.costs, self.backs = [START], [0], [()]
        self.made = 0

    def answer(self, signature: str) -> tuple[int, str]:
        """Least cost and the ASCII-least of the cheapest edits."""
        depth = len(os.path.commonprefix([self.signature, signature]))
        for held in (self.layers, self.costs, self.backs):
            del held[depth + 1 :]
        for letter in signature[depth:]:
            layer, cost, back = step(self.layers[-1], letter)
            self.layers.append(layer)
            self.costs.append(self.costs[-1] + cost)
            self.backs.append(back)
            self.made += 1
        self.signature = signature
        layer = self.layers[-1]
        cost, _, n, state = min((cost, layer[origin][1], n, origin) for state, cost, origin, n in _with_inserts(layer) if state in (EMPTY, ASSISTANT))
        edits = ["I" * n]
        for back in self.backs[:0:-1]:
            state, n, edit = back[state]
            edits.append("I" * n + edit)
        return self.costs[-1] + cost, "".join(reversed(edits))


def cheapest_edits(signed: DataFrame) -> DataFrame:
    """Add ``cost`` and ``audit`` to rows with a ``signature``."""

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last = Trie(), (None, None)
        for batch in batches:
            found = []
            for signature in batch.column("signature").to_pylist():
                if signature != last[0]:
                    last = signature, trie.answer(signature)
                found.append(last[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], [*batch.schema.names, "cost", "audit"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in signed.schema)
    return signed.sortWithinPartitions("signature").mapInArrow(walk, f"{schema}, cost long, audit string")


def apply_edits(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the repaired turns, by conversation and place, from turns and (conv_id, audit).

    A conversation's edits come first in its sorted stream, so that a task holds one turn and one conversation's edits at a time.
    """
    rows = _filled(turns).select("conv_id", F.lit(1).alias("nth"), "turn", _digest().alias("h"), "role", "text")
    heads = audits.select("conv_id", F.lit(0).alias("nth"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("h"), F.lit("").alias("role"), F.col("audit").alias("text"))

    def edit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place, out = "", 0, EMPTY, 0, ([], [], [], [])

        def emit(conv: object, role: str, text: str, then: int) -> None:
            nonlocal state, place
            for held, value in zip(out, (conv, place, role, text), strict=True):
                held.append(value)
            state, place = then, place + 1

        conv: object = None
        for batch in batches:
            for own, nth, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "nth", "role", "text")), strict=True):
                if not nth:
                    conv, audit, at, state, place = own, text, 0, EMPTY, 0
                else:
                    what, at = audit[at], at + 1
                    if what == "K":
                        emit(conv, role, text, FOLLOWS[role[0]][1])
                    elif what == "R":
                        emit(conv, ROLE[NEXT[state]], text, NEXT[state])
                while at < len(audit) and audit[at] == "I":
                    at += 1
                    emit(conv, ROLE[NEXT[state]], "", NEXT[state])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field("conv_id").type), pa.array(out[1], pa.int64()), *(pa.array(x, pa.string()) for x in out[2:])], ["conv_id", "place", "role", "text"])
            out = ([], [], [], [])

    kind = turns.schema["conv_id"].dataType.simpleString()
    return heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "nth", "turn", "h").select("conv_id", "nth", "role", "text").mapInArrow(edit, f"conv_id {kind}, place long, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of what ``apply_edits`` returns, which is by conversation and place: the hash runs along its stream."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            done = []
            for own, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")), strict=True):
                if place == 0:
                    if digest:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = own, hashlib.sha256()
                digest.update(f"{chr(10) * (place > 0)}{role}:{text}".encode())
            kind = batch.schema.field("conv_id").type
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], ["conv_id", "repaired_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    return repaired.mapInArrow(run, f"conv_id {repaired.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")


def audits(turns: DataFrame) -> DataFrame:
    """Per conversation of (conv_id, turn, role, text): signature, gaps, blank, duplicate, truncated, illegal, cost and audit; a written table.

    Turns go by number, null first; different rows of one number by a digest, equal ones stand side by side.  A null role or text is one space; a null
    id is a conversation of its own.  A turn's first fault counts: blank, equal to an earlier turn, cut off.  Blank and repeated turns are deleted;
    the rest is kept, given another role or deleted and empty turns are inserted so that roles read system (or none), then user and assistant in
    turns, at the least cost, ties by the ASCII order of the edits' initials.  Other columns are ignored; an empty table gives no rows.
    """
    return materialize(cheapest_edits(signatures(turns)), "audits")


def report(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """The audit of ``turns`` and the digest of the repaired text for every id of ``conversations``; zeros, empty audit and the digest of nothing where no turn is."""
    found = audits(turns)
    repaired = digests(apply_edits(turns, found))
    ids = conversations.select("conv_id").distinct()
    rows = ids.alias("i").join(found.alias("a"), F.expr("i.conv_id <=> a.conv_id"), "left").join(repaired.alias("d"), F.expr("i.conv_id <=> d.conv_id"), "left")
    counts = [F.coalesce(F.col(f"a.{c}"), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.select("i.conv_id", *counts, F.coalesce("a.audit", F.lit("")).alias("audit"), F.coalesce("d.repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
