"""Conversation structure repair by a persistent audit DP.

A conversation is well formed when its roles read (s?(ua)+)?: an optional
system turn, then user and assistant in turns, or nothing at all. The cheapest
edits that make it so are found by a dynamic program over its rows with four
states (nothing yet, after system, after user, after assistant). Each state
keeps its cost and its *audit*, the edits' initials in order: Keep 0, Rerole 3,
Delete 4 (a must for blank and duplicate rows), Insert 3; a truncated row that
stays costs 3 more. Of equal costs the ASCII-least audit wins.

Audits are not copied: each is a node that links to the audit it extends and
holds binary-lifting ancestors and a rolling hash. A tie searches the longest
common prefix by lifting both nodes while their hashes differ; equal hashes are
verified (the same node, or else compared step by step), and a collision falls
back to comparing the audits themselves.

Conversations of any length are cut into *segments* of bounded rows and bytes.
Rows are range-partitioned and sorted by (conversation, turn, role, text), so
one conversation may lie in many tasks. A segment that is a whole conversation
is solved at once; of others each task gives the best audit from every state to
every state, and these pieces are joined by the same DP, with pieces as edits'
strings. Only narrow pieces of one conversation ever meet in one task.

Faults, first one counts: blank (no character but space and 0x09-0x0D),
duplicate (role and text seen earlier in the conversation), truncated (the
last other character is none of . ! ?).

Defined cases: null roles and texts are one space (so a null text is blank); a
null `conv_id` is a conversation of its own; rows come by turn, nulls first,
then by role and text; repeated rows are duplicates; a conversation without
rows has counts of 0 and an empty audit; an empty table gives no rows; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import stage, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
NONE, SYSTEM, USER, ASSISTANT = range(4)  # states
SEGMENT_ROWS, SEGMENT_BYTES = 4096, 8 << 20
SALTS = 16
BLANK = " \t\n\x0b\x0c\r"

#: state -> state for a user or assistant turn
_NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NAME = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}


# --- persistent audits -------------------------------------------------------


class Audit:
    """A string as a node: what it extends, by what, and all of its prefixes
    at distances of powers of two."""

    __slots__ = ("up", "depth", "hash", "label", "at")

    def __init__(self, up: list, depth: int, hash_: int, label: str, at=None):
        self.up, self.depth, self.hash, self.label, self.at = up, depth, hash_, label, at


class Audits:
    """Makes and compares audits; `modulus` bounds the rolling hashes."""

    def __init__(self, modulus: int = (1 << 61) - 1, base: int = 1_000_003):
        self.modulus, self.base = modulus, base
        self.root = Audit([], 0, 0, "")
        self.collisions = 0

    def extend(self, parent: Audit, label: str, at=None) -> Audit:
        up, k = [parent], 0
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1
        h = parent.hash
        for c in label:
            h = (h * self.base + ord(c)) % self.modulus
        return Audit(up, parent.depth + 1, h, label, at)

    @staticmethod
    def nodes(a: Audit, above: Audit | None = None) -> list[Audit]:
        """The nodes from `above` (not included) down to `a`."""
        out = []
        while a is not above and a.up:
            out.append(a)
            a = a.up[0]
        return out[::-1]

    def text(self, a: Audit, above: Audit | None = None) -> str:
        return "".join([n.label for n in self.nodes(a, above)])

    @staticmethod
    def _lift(a: Audit, depth: int) -> Audit:
        while a.depth > depth:
            a = a.up[min((a.depth - depth).bit_length(), len(a.up)) - 1]
        return a

    @staticmethod
    def _same(a: Audit, b: Audit) -> bool:
        """Whether nodes of equal depth hold equal strings, label by label."""
        while a is not b:
            if a.label != b.label:
                return False
            a, b = a.up[0], b.up[0]
        return True

    def less(self, a: Audit, b: Audit) -> bool:
        """Whether the string of `a` comes before that of `b`."""
        depth = min(a.depth, b.depth)
        x, y = self._lift(a, depth), self._lift(b, depth)
        if x.hash == y.hash and self._same(x, y):
            return self.text(a, x) < self.text(b, y)
        if x.hash == y.hash:
            self.collisions += 1
            return self.text(a) < self.text(b)
        for k in range(len(x.up) - 1, -1, -1):
            if k < len(x.up) and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        if not self._same(x.up[0], y.up[0]):
            self.collisions += 1
            return self.text(a) < self.text(b)
        if x.label.startswith(y.label) or y.label.startswith(x.label):
            return self.text(a, x.up[0]) < self.text(b, y.up[0])
        return x.label < y.label


class Best:
    """The best (cost, audit) of each state."""

    def __init__(self, audits: Audits):
        self.audits = audits
        self.cost: list[int | None] = [None] * 4
        self.audit: list[Audit | None] = [None] * 4

    def offer(self, state: int, cost: int, parent: Audit, label: str, at=None) -> None:
        if self.cost[state] is None or cost < self.cost[state]:
            self.cost[state], self.audit[state] = cost, self.audits.extend(parent, label, at) if label else parent
        elif cost == self.cost[state]:
            new = self.audits.extend(parent, label, at) if label else parent
            if self.audits.less(new, self.audit[state]):
                self.audit[state] = new

    def insert(self) -> None:
        """Inserted turns after what is there: at most two in a row pay."""
        for state in (NONE, SYSTEM, ASSISTANT, USER):
            if self.cost[state] is not None:
                self.offer(_NEXT[state], self.cost[state] + INSERT, self.audit[state], "I")

    def end(self) -> tuple[int, Audit]:
        """The best of the two states a conversation may end in."""
        last = Best(self.audits)
        for state in (NONE, ASSISTANT):
            if self.cost[state] is not None:
                last.offer(0, self.cost[state], self.audit[state], "")
        return last.cost[0], last.audit[0]


def solve(rows: list[tuple[str, bool, bool]], start: int, audits: Audits, whole: bool) -> Best:
    """The DP over rows (role initial, must go, truncated) from one state;
    turns may be inserted before the first row only where `whole`."""
    now = Best(audits)
    now.offer(start, 0, audits.root, "")
    if whole:
        now.insert()
    for initial, must_go, truncated in rows:
        new = Best(audits)
        extra = TRUNCATED if truncated else 0
        for state in range(4):
            cost, audit = now.cost[state], now.audit[state]
            if cost is None:
                continue
            new.offer(state, cost + DELETE, audit, "D")
            if must_go:
                continue
            to = _NEXT[state]
            if initial == _NAME[to][0]:
                new.offer(to, cost + KEEP + extra, audit, "K")
            elif initial == "s" and state == NONE:
                new.offer(SYSTEM, cost + KEEP + extra, audit, "K")
            new.offer(to, cost + REROLE + extra, audit, "R")
        new.insert()
        now = new
    return now


def apply_audit(state: int, audit: str, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The repaired (role, text) rows of a segment entered in `state`."""
    out, at = [], 0
    for edit in audit:
        if edit == "I":
            state = _NEXT[state]
            out.append((_NAME[state], ""))
            continue
        role, text = rows[at]
        at += 1
        if edit == "D":
            continue
        state = SYSTEM if edit == "K" and role[:1] == "s" else _NEXT[state]
        out.append((_NAME[state] if edit == "R" else role, text))
    return out


# --- rows in order, with their faults ----------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of `conversations` as the test of a repair wants them, by
    crc32(`conv_id:turn`) % 20: 0 loses the row, 1 its text, 2 its . ! ?, 3
    doubles it, 4 makes it the user's. `copies` tells how often a row stands."""
    one = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    how = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(F.col("role"), one), F.coalesce(F.col("text"), one)
    return (
        conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
        .withColumn("_how", how)
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_how") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("_how") == 1, F.lit("")).when(F.col("_how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.when(F.col("_how") == 0, 0).when(F.col("_how") == 3, 2).otherwise(1).alias("copies"),
        )
    )


def _with_faults(rows: DataFrame) -> DataFrame:
    """blank, truncated, and `again`: role and text stand at an earlier turn.

    The first turn of each (conversation, role, text) is a partial aggregate on
    a digest; only those seen at several turns are joined back, and as one of
    them may hold many rows, by (digest, salt)."""
    one = F.lit(" ")
    bare = F.rtrim(F.col("text"), F.lit(BLANK))
    digest = F.sha2(
        F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit(":"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"),
        256,
    )
    rows = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", one).alias("role"),
        F.coalesce("text", one).alias("text"),
        "copies",
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        F.unhex(digest).alias("_digest"),
        F.pmod(F.xxhash64("turn"), F.lit(SALTS)).alias("_salt"),
    )
    first = (
        rows.filter("copies > 0 and not blank")
        .groupBy("_digest")
        .agg(F.min("turn").alias("_min"), F.max("turn").alias("_max"), F.max(F.col("turn").isNull()).alias("_null"))
        .filter("_min < _max or (_null and _min is not null)")
        .select("_digest", "_min", "_null", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
    )
    again = F.when(F.col("_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_min"))
    return rows.join(first, ["_digest", "_salt"], "left").select(
        "conv_id", "turn", "role", "text", "copies", "blank", "truncated", F.coalesce(again, F.lit(False)).alias("again")
    )


def _in_order(rows: DataFrame) -> DataFrame:
    # the sample that sets the ranges is read by the driver: beginnings of texts are enough for it
    ranges = [F.col("conv_id"), F.col("turn"), F.substring("role", 1, 32), F.substring("text", 1, 32)]
    return rows.repartitionByRange(*ranges).sortWithinPartitions("conv_id", "turn", "role", "text")


# --- segments ----------------------------------------------------------------

_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_PIECES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
SEGMENT = (
    "conv_id long, seg long, whole boolean, blank long, duplicate long, truncated long, illegal long, "
    "first_turn long, last_turn long, turns_seen long, first_role string, last_role string, "
    "cost long, audit string, pieces array<struct<start:int,end:int,cost:long,audit:string>>, "
    "turns array<struct<role:string,text:string>>"
)
_SEGMENT_KINDS = [
    *[pa.int64()] * 2, pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string(), pa.int64(), pa.string(), _PIECES, _TURNS,
]


class _Segment:
    """Rows of one conversation, being collected."""

    def __init__(self, conv_id, opens: bool):
        self.conv_id, self.opens = conv_id, opens  # opens: nothing of the conversation comes before
        self.rows: list[tuple[str, str]] = []
        self.todo: list[tuple[str, bool, bool]] = []
        self.size = 0
        self.count = dict.fromkeys(_COUNTS, 0)
        self.turns: list = []  # first, last, and how many different ones

    def add(self, turn, role: str, text: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        duplicate = duplicate and not blank
        truncated = truncated and not (blank or duplicate)
        initial = role[:1]
        self.count["blank"] += blank
        self.count["duplicate"] += duplicate
        self.count["truncated"] += truncated
        if self.todo and self.todo[-1][0] + initial not in _LEGAL:
            self.count["illegal"] += 1
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        self.rows.append((role, text))
        self.todo.append((initial, blank or duplicate, truncated))
        self.size += len(role) + len(text)

    def row(self, seg: int, closes: bool) -> tuple:
        whole = self.opens and closes
        audits = Audits()
        cost, audit, pieces = None, None, None
        if whole:
            cost, node = solve(self.todo, NONE, audits, True).end()
            audit = audits.text(node)
            turns = apply_audit(NONE, audit, self.rows)
        else:
            pieces = []
            for start in range(4):
                best = solve(self.todo, start, audits, False)
                pieces += [
                    {"start": start, "end": end, "cost": best.cost[end], "audit": audits.text(best.audit[end])}
                    for end in range(4)
                    if best.cost[end] is not None
                ]
            turns = self.rows
        first, last, seen = self.turns or (None, None, 0)
        ends = (self.todo[0][0], self.todo[-1][0]) if self.todo else (None, None)
        turns = [{"role": r, "text": t} for r, t in turns]
        return (self.conv_id, seg, whole, *[self.count[c] for c in _COUNTS], first, last, seen, *ends, cost, audit, pieces, turns)


def _segments(rows: DataFrame, most_rows: int, most_bytes: int) -> DataFrame:
    names = [c.split()[0] for c in SEGMENT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, serial = TaskContext.get().partitionId() << 40, 0
        seg: _Segment | None = None
        before: tuple | None = None
        out: list[tuple] = []
        held = 0

        def close(closes: bool) -> None:
            nonlocal serial, held
            out.append(seg.row(base + serial, closes))
            serial += 1
            held += seg.size

        def flush() -> pa.RecordBatch:
            nonlocal out, held
            got = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _SEGMENT_KINDS)], names=names)
            out, held = [], 0
            return got

        for b in batches:
            for conv_id, turn, role, text, copies, blank, truncated, again in zip(*[c.to_pylist() for c in b.columns]):
                if seg is None:  # the first conversation of a task may begin in an earlier one
                    seg = _Segment(conv_id, False)
                elif conv_id != seg.conv_id:
                    close(True)
                    seg, before = _Segment(conv_id, True), None
                for _ in range(copies):
                    if len(seg.rows) >= most_rows or (seg.rows and seg.size + len(text) > most_bytes):
                        close(False)
                        seg = _Segment(conv_id, False)
                    this = (turn, role, text)
                    seg.add(turn, role, text, blank, again or this == before, truncated)
                    before = this
                if len(out) >= 1000 or held > most_bytes:
                    yield flush()
        if seg is not None:  # and the last one may go on in a later task
            close(False)
        if out:
            yield flush()

    return rows.mapInArrow(run, SEGMENT)


CHOSEN = "seg long, start int, chunk string, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string"
_CHOSEN_KINDS = [pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 6, pa.string()]


def _join_pieces(pieces: DataFrame) -> DataFrame:
    """For every segment of a cut conversation the state it is entered in and
    its part of the audit; the first one also carries the conversation's counts.
    `pieces` come sorted by conversation and segment, none split over tasks."""

    def solve_conversation(audits: Audits, segs: Iterator[dict]) -> list[tuple]:
        now = Best(audits)
        now.offer(NONE, 0, audits.root, "")
        now.insert()
        count = dict.fromkeys(_COUNTS, 0)
        first = last = role = None
        seen, ids = 0, []
        for s in segs:
            new = Best(audits)
            for p in s["pieces"]:
                if now.cost[p["start"]] is not None:
                    new.offer(p["end"], now.cost[p["start"]] + p["cost"], now.audit[p["start"]], p["audit"], (s["seg"], p["start"]))
            now = new
            ids.append(s["seg"])
            for c in _COUNTS:
                count[c] += s[c]
            if s["first_role"] is not None:
                if role is not None and role + s["first_role"] not in _LEGAL:
                    count["illegal"] += 1
                role = s["last_role"]
            if s["first_turn"] is not None:
                seen += s["turns_seen"] - (s["first_turn"] == last)
                first = s["first_turn"] if first is None else first
                last = s["last_turn"]
        cost, audit = now.end()
        part: dict[int, list] = {}
        lead = ""
        for n in audits.nodes(audit):
            if n.at is None:
                lead += n.label
            else:
                part[n.at[0]] = [n.at[1], n.label]
        gaps = last - first + 1 - seen if first is not None else 0
        out = []
        for k, i in enumerate(ids):
            start, chunk = part.get(i, (NONE, ""))
            if k == 0 and lead:
                start, chunk = NONE, lead + chunk
            totals = (*count.values(), gaps, cost, audits.text(audit)) if k == 0 else (None,) * 7
            out.append((i, start, chunk, *totals))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        def each() -> Iterator[dict]:
            for b in batches:
                for k in range(b.num_rows):
                    yield b.slice(k, 1).to_pylist()[0]

        names = [c.split()[0] for c in CHOSEN.split(", ")]
        for _, segs in groupby(each(), key=lambda s: s["conv_id"]):
            rows = solve_conversation(Audits(), segs)
            for k in range(0, len(rows), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 1000]), _CHOSEN_KINDS)], names=names)

    return pieces.mapInArrow(run, CHOSEN)


CHUNK = (
    "conv_id long, seg long, whole boolean, blank long, duplicate long, truncated long, illegal long, gaps long, "
    "cost long, audit string, turns array<struct<role:string,text:string>>"
)


def _apply(chosen: DataFrame) -> DataFrame:
    """Segments of cut conversations with the repaired rows in place of theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                one = b.slice(k, 1)
                row = one.select(["start", "chunk", "turns"]).to_pylist()[0]
                turns = apply_audit(row["start"], row["chunk"], [(t["role"], t["text"]) for t in row["turns"]])
                cols = [one.column(c) for c in _CHUNK_NAMES[:-1]]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([[{"role": r, "text": t} for r, t in turns]], _TURNS)], names=_CHUNK_NAMES)

    return chosen.mapInArrow(run, CHUNK)


_CHUNK_NAMES = ["conv_id", "seg", "whole", *_COUNTS, "gaps", "cost", "audit", "turns"]


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Repaired conversations in chunks: conv_id, seg (chunks of a conversation
    in order), whole (the only chunk), turns (repaired rows), and on the first
    chunk blank, duplicate, truncated, illegal, gaps, cost and audit.

    `rows`: conv_id, turn, role, text and `copies`, how often a row stands
    (0: only tells that there is such a conversation)."""
    segs = stage(_segments(_in_order(_with_faults(rows)), segment_rows, segment_bytes), "conversation-segments")
    gaps = F.when(F.col("first_turn").isNull(), 0).otherwise(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns_seen"))
    done = segs.filter("whole").select("conv_id", "seg", "whole", *_COUNTS, gaps.alias("gaps"), "cost", "audit", "turns")
    cut = segs.filter("not whole")
    narrow = cut.drop("turns", "whole", "cost", "audit").repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    chosen = _join_pieces(narrow)
    rest = cut.select("conv_id", "seg", "whole", "turns").join(chosen, "seg").select(*_CHUNK_NAMES, "start", "chunk")
    return done.unionByName(_apply(rest))


def digests(chunks: DataFrame) -> DataFrame:
    """One row for each conversation: the first chunk's columns and
    `repaired_sha256` of its `role:text` lines. Lines of a cut conversation are
    hashed chunk by chunk, in order."""
    names = ["conv_id", *_COUNTS, "gaps", "cost", "audit"]
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    done = chunks.filter("whole").select(*names, F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.RecordBatch | None = None
        sha, any_line = hashlib.sha256(), False

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[kept.column(c) for c in names], pa.array([sha.hexdigest()])], names=[*names, "repaired_sha256"])

        for b in batches:
            for k in range(b.num_rows):
                one = b.slice(k, 1)
                if kept is None or one.column("conv_id")[0].as_py() != kept.column("conv_id")[0].as_py():
                    if kept is not None:
                        yield close()
                    kept, sha, any_line = one.select(names), hashlib.sha256(), False
                if one.column("n")[0].as_py():
                    sha.update((b"\n" if any_line else b"") + one.column("lines")[0].as_py().encode())
                    any_line = True
        if kept is not None:
            yield close()

    cut = chunks.filter("not whole").select(*names, "seg", F.size("turns").alias("n"), lines.alias("lines"))
    schema = "conv_id long, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string, repaired_sha256 string"
    cut = cut.repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(run, schema)
    return done.unionByName(cut)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    out = digests(repair(damage(table(spark, sf_dir, "conversations"))))
    return out.select("conv_id", "gaps", *_COUNTS, "cost", "audit", "repaired_sha256")


# --- the same in SQL ---------------------------------------------------------


def _add(state: str, cost: str, edit: str, when: str = "true") -> str:
    """A state is its cost in nine digits and then its audit."""
    return f"case when {when} then printf('%09d', left({state}, 9)::int + {cost}) || substr({state}, 10) || '{edit}' end"


def _least(*options: str) -> str:
    return f"least({', '.join(options)})"


_RE = "not gone and "
OP11_SQL = f"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, '-') as ck,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
  from conversations
), hashed as (
  select *, xor(list_reduce(
    list_prepend(4294967295::bigint, flatten(list_transform(string_split(key, ''), lambda c: list_prepend(ascii(c)::bigint, [-1::bigint, -1, -1, -1, -1, -1, -1, -1])) )),
    lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, (a & 1) * 3988292384::bigint) end), 4294967295::bigint) as crc
  from keyed
), damaged as (
  select ck, turn, case when crc % 20 = 4 then 'user' else role end as role,
    case crc % 20 when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case crc % 20 when 3 then [1, 2] else [1] end) as copy
  from hashed where crc % 20 <> 0
), bare as (
  select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as b, left(role, 1) as initial,
    row_number() over (partition by ck, role, text order by i) as nth
  from (select *, row_number() over (partition by ck order by turn nulls first, role, text) as i from damaged)
), faults as (
  select *, case when b = '' then 'blank' when nth > 1 then 'duplicate' when right(b, 1) not in ('.', '!', '?') then 'truncated' end as fault,
    lag(initial) over (partition by ck order by i) as initial_before
  from bare
), rows as (
  select ck, i, role, text, initial, coalesce(fault in ('blank', 'duplicate'), false) as gone,
    case when fault = 'truncated' then {TRUNCATED} else 0 end as extra
  from faults
), counts as (
  select ck, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (initial_before is not null and initial_before || initial not in ('su', 'ua', 'au')) as illegal
  from faults group by ck
), states as (
  select ck, 0::bigint as i, '000000000' as p0, null::varchar as p1, '000000003I' as p2, '000000006II' as p3 from counts
  union all
  select ck, i, q0, q1, r2, {_least("q3", _add("r2", "3", "I"))}
  from (
    select ck, i, q0, q1, q3, {_least("q2", _add("q0", "3", "I"), _add("q1", "3", "I"), _add("q3", "3", "I"))} as r2
    from (
      select r.ck, r.i, {_add("p0", "4", "D")} as q0,
        {_least(_add("p1", "4", "D"), _add("p0", "extra", "K", _RE + "initial = 's'"))} as q1,
        {_least(_add("p2", "4", "D"),
                *[_add(p, "extra", "K", _RE + "initial = 'u'") for p in ("p0", "p1", "p3")],
                *[_add(p, "extra + 3", "R", "not gone") for p in ("p0", "p1", "p3")])} as q2,
        {_least(_add("p3", "4", "D"), _add("p2", "extra", "K", _RE + "initial = 'a'"), _add("p2", "extra + 3", "R", "not gone"))} as q3
      from states join rows r on r.ck = states.ck and r.i = states.i + 1
    )
  )
), best as (
  select s.ck, least(p0, p3) as b from states s join counts c on s.ck = c.ck and s.i = c.n
), edits as (
  select ck, pos, substr(b, 9 + pos, 1) as e from (select ck, b, unnest(range(1, length(b) - 8)) as pos from best)
), placed as (
  select *, count(*) filter (e <> 'I') over w as i, count(*) filter (e <> 'D') over w as o
  from edits window w as (partition by ck order by pos)
), lines as (
  select p.ck, p.pos, p.e, p.o, r.role, r.text,
    max(case when p.o = 1 and p.e = 'K' and r.initial = 's' then 1 else 0 end) over (partition by p.ck) as s
  from placed p left join rows r on r.ck = p.ck and r.i = p.i and p.e <> 'I' where p.e <> 'D'
), repaired as (
  select ck, string_agg(case when e = 'K' then role when (o - s) % 2 = 1 then 'user' else 'assistant' end || ':' ||
    case when e = 'I' then '' else text end, chr(10) order by pos) as t
  from lines group by ck
)
select c.conv_id, coalesce(n.gaps, 0) as gaps, coalesce(n.blank, 0) as blank, coalesce(n.duplicate, 0) as duplicate,
  coalesce(n.truncated, 0) as truncated, coalesce(n.illegal, 0) as illegal, coalesce(left(b.b, 9)::bigint, 0) as cost,
  coalesce(substr(b.b, 10), '') as audit, sha256(coalesce(r.t, '')) as repaired_sha256
from (select distinct conv_id, ck from keyed) c left join counts n using (ck) left join best b using (ck) left join repaired r using (ck)
"""
