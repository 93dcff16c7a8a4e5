"""Conversation repair against every possible edit, and in SQL."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import types as T

from recurra.llm import conversation_repair as repair

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        # names that the operator uses inside
        T.StructField("seg", T.StringType()),
        T.StructField("copies", T.IntegerType()),
        T.StructField("_digest", T.BinaryType()),
        T.StructField("turns", T.MapType(T.StringType(), T.LongType())),
    ]
)


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", 9, b"z", {"a": k}) for k, r in enumerate(rows)], SCHEMA).repartition(parts)


def brute(rows):
    """The cheapest audit of (initial, must go, truncated) rows, ASCII-least
    of equals, by trying all edits with up to three insertions at each place."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for ins in itertools.product(range(4), repeat=len(rows) + 1):
            if sum(ins) > 3:
                continue
            audit, cost, roles = "I" * ins[0], 3 * ins[0], ["i"] * ins[0]
            ok = True
            for (initial, must, cut), e, n in zip(rows, edits, ins[1:]):
                if e != "D" and must:
                    ok = False
                    break
                cost += {"D": 4, "K": 0, "R": 3}[e] + (3 if cut and e != "D" else 0) + 3 * n
                roles += [] if e == "D" else ["i" if e == "R" else initial]
                roles += ["i"] * n
                audit += e + "I" * n
            if not ok or (best and (cost, audit) >= best):
                continue
            # a rerolled or inserted turn may be of either role
            if any(
                re.fullmatch("(s?(ua)+)?", "".join(next(p) if r == "i" else r or "?" for r in roles))
                for pick in itertools.product("ua", repeat=roles.count("i"))
                for p in [iter(pick)]
            ):
                best = (cost, audit)
    return best


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 1, 5])
def test_dp_equals_brute_force(modulus):
    rng = random.Random(11)
    collisions = 0
    for _ in range(60 if modulus > 5 else 25):
        rows = [(rng.choice("suuaa t"), rng.random() < 0.25, rng.random() < 0.3) for _ in range(rng.randrange(0, 5))]
        audits = repair.Audits(modulus)
        cost, node = repair.solve(rows, repair.NONE, audits, True).end()
        assert (cost, audits.text(node)) == brute(rows), rows
        collisions += audits.collisions
    assert (collisions > 0) is (modulus <= 5)


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 7])
def test_order_of_audits(modulus):
    rng = random.Random(2)
    audits = repair.Audits(modulus)

    def make(labels):
        node = audits.root
        for x in labels:
            node = audits.extend(node, x)
        return node

    for _ in range(3000):
        shared = make([rng.choice("DIKR") for _ in range(rng.randrange(0, 40))])
        a, b = shared, shared
        for _ in range(rng.randrange(0, 6)):
            a = audits.extend(a, "".join(rng.choice("DK") for _ in range(rng.randrange(1, 4))))
        for _ in range(rng.randrange(0, 6)):
            b = audits.extend(b, "".join(rng.choice("DK") for _ in range(rng.randrange(1, 4))))
        assert audits.less(a, b) == (audits.text(a) < audits.text(b))


def sample(seed=4, n=60):
    rng = random.Random(seed)
    rows = []
    for c in [None, *range(n)]:
        for t in range(rng.choice([1, 2, 3, 6, 9])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice([None, "", " \t\n", "Yes.", "yes", "Why?", "a b\n", "é! ", f"t{rng.randrange(5)}.", "x\xa0", "漢字。"])
            turn = rng.choice([t, t, t, t + 3, None, t - 1])
            rows += [(c, turn, role, text)] * rng.choice([1, 1, 1, 2])
    rows += [(900, t, "user" if t % 2 else "assistant", "same.") for t in range(40)]
    rows += [(901, t, ["user", "assistant"][t % 2], f"turn {t}{'.' if t % 7 else ''}") for t in range(200)]
    rows += [(902, 5, "user", "again and again.")] * 30
    return rows


def by_hand(rows):
    """Every column, in plain Python (the DP itself is tested above)."""
    out = {}
    for c in {r[0] for r in rows}:
        mine = []
        for _, turn, role, text in (r for r in rows if r[0] == c):
            key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            role, text, how = role if role is not None else " ", text if text is not None else " ", zlib.crc32(key.encode()) % 20
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            mine += [] if how == 0 else [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, todo, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in mine:
            bare = text.rstrip(repair.BLANK)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            todo.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(todo, todo[1:]))
        audits = repair.Audits()
        cost, node = repair.solve(todo, repair.NONE, audits, True).end()
        audit = audits.text(node)
        lines = [f"{r}:{t}" for r, t in repair.apply_audit(repair.NONE, audit, [(r, t) for _, r, t in mine])]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out[c] = (gaps, *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("rows,size", [(4096, 8 << 20), (4, 1 << 20), (1, 1 << 20), (50, 30)])
def test_cut_anywhere_equals_by_hand(spark, rows, size):
    given = sample()
    out = repair.digests(repair.repair(repair.damage(frame(spark, given)), rows, size)).select(COLUMNS)
    got = out.collect()
    assert len(got) == len({r["conv_id"] for r in got})
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == by_hand(given)


def test_sql_says_the_same(spark, tmp_path):
    given = sample(8)
    frame(spark, given).write.parquet(f"{tmp_path}/conversations.parquet")
    out = repair.op11_conversations(spark, str(tmp_path))
    assert out.columns == COLUMNS and [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"] * 2
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    cur = con.execute(repair.OP11_SQL)
    assert [d[0] for d in cur.description] == COLUMNS
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(cur.fetchall(), key=repr)


def test_nothing_and_all_lost(spark):
    assert repair.digests(repair.repair(repair.damage(frame(spark, [])))).count() == 0
    lost = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    (row,) = repair.digests(repair.repair(repair.damage(frame(spark, [(1, lost, "user", "x.")])))).select(COLUMNS).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
