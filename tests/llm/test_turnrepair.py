import hashlib
import random
import zlib

import duckdb

from squall.llm import turnrepair
from squall.llm.turnrepair import Tables

SPACES = " \t\n\v\f\r"


def plain_repair(rows):
    """Least cost, then ASCII-least audit, for rows (role, text, fault): every state keeps its best so far."""
    opened = {0: "u", 1: "u", 2: "a", 3: "u"}
    to = {"s": 1, "u": 2, "a": 3}
    name = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(3):
            for s, (cost, audit, lines) in list(best.items()):
                i = opened[s]
                new = (cost + 3, audit + "I", lines + (name[i] + ":",))
                if to[i] not in best or new[:2] < best[to[i]][:2]:
                    best[to[i]] = new
        return best

    best = {0: (0, "", ())}
    for role, text, fault in rows:
        after = {}
        for s, (cost, audit, lines) in inserted(best).items():
            options = [(s, cost + 4, "D", ())]
            if fault not in ("blank", "duplicate"):
                cut = 3 * (fault == "truncated")
                options.append((to[opened[s]], cost + 3 + cut, "R", (f"{name[opened[s]]}:{text}",)))
                if role[:1] == opened[s] or (s == 0 and role[:1] == "s"):
                    options.append((to[role[0]], cost + cut, "K", (f"{role}:{text}",)))
            for at, paid, letter, line in options:
                new = (paid, audit + letter, lines + line)
                if at not in after or new[:2] < after[at][:2]:
                    after[at] = new
        best = after
    best = inserted(best)
    return min((best[s] for s in (0, 3) if s in best), key=lambda b: b[:2])


def plain_digest(turns):
    """From (conv_id, turn, role, text) rows without damage."""
    by = {}
    for conv, turn, role, text in turns:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, marked = set(), []
        for _, role, text in rows:
            cut = text.rstrip(SPACES)
            fault = "blank" if not cut else "duplicate" if (role, text) in seen else "truncated" if cut[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
        have = [t for t, _, _ in rows if t is not None]
        cost, audit, lines = plain_repair(marked)
        out[conv] = (max(have) - min(have) + 1 - len(set(have)) if have else 0, *(sum(f == k for _, _, f in marked) for k in ("blank", "duplicate", "truncated")),
                     sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def damage(turns):
    for conv, turn, role, text in turns:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        for _ in range(0 if kind == 0 else 2 if kind == 3 else 1):
            yield conv, turn, "user" if kind == 4 else role, text


def some_turns(g, conv, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    texts = ["Fine.", "cut off", "what?", " \n", None, "", "é!", "end. \t", "x" * 50]
    return [(conv, None if g.random() < 0.05 else g.randrange(n), g.choice(roles[:5] if g.random() < 0.8 else roles),
             g.choice(texts) if g.random() < 0.5 else f"turn {g.randrange(n)}{g.choice('.! ,')}") for _ in range(n)]


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, True, 3) for r in rows],
                                 "conv_id long, turn long, role string, text string, at int, key string, segment int, blank boolean, step int")


def check(spark, rows, segment, monkeypatch):
    monkeypatch.setattr(turnrepair, "SEGMENT", segment)
    df = frame(spark, rows)
    got = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in turnrepair.digest(df, df).collect()}
    assert got == plain_digest(rows)


def test_block_tables_equal_single_steps():
    g = random.Random(1)
    t = Tables()
    for width in (1, 2, 3, 5):
        other = Tables(width)
        assert other.vectors == t.vectors
        for n in (0, 1, 3, 4, 17, 64):
            symbols = bytes(g.choice(b"01234567") for _ in range(n))
            (a, b), (c, d) = t.segment(symbols), other.segment(symbols)
            assert a.tolist() == c.tolist() and b.tolist() == d.tolist()
    assert all(min(v) == 0 for v in t.vectors) and len(t.vectors) < 100


def test_segments_of_any_length_repair_as_the_plain_search(spark, monkeypatch):
    g = random.Random(2)
    rows = [r for conv in range(60) for r in some_turns(g, conv, g.choice([1, 2, 3, 6, 25]))]
    rows += some_turns(g, None, 30) + some_turns(g, 1000, 400) + [(70, 1, "user", "same."), (70, 1, "user", "same."), (70, 1, "user", "same.")]
    rows += [(71, 5, "user", "word " * 200_000 + "."), (71, 6, "assistant", " " * 300_000)]
    check(spark, rows, 7, monkeypatch)
    check(spark, rows[:80], 4096, monkeypatch)


def test_edits_give_the_repaired_conversation(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 4, "tool", "result.")]
    got = [(r["edit"], bytes(r["role"] or b""), bytes(r["text"]), r["fault"], r["least"]) for r in turnrepair.repair(frame(spark, rows)).collect()]
    assert got == [("K", b"system", b"Be kind.", None, 7), ("K", b"user", b"Hi.", None, 7), ("D", b"", b"Hi.", "duplicate", 7), ("R", b"assistant", b"result.", None, 7)]


def test_damage_follows_the_key(spark):
    g = random.Random(3)
    rows = [r for conv in range(40) for r in some_turns(g, conv, 12)] + some_turns(g, None, 25)
    got = turnrepair.damaged(frame(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, damage(rows)))


def test_every_conversation_is_returned(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = frame(spark, [(lost, 0, "user", "Hi."), (lost + 1000, 0, "user", "Hi.")])
    got = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in turnrepair.digest(turnrepair.damaged(df), df).collect()}
    assert got[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and len(got) == 2
    none = df.where("false")
    assert turnrepair.digest(turnrepair.damaged(none), none).count() == 0


def test_sql_on_odd_rows(spark):
    g = random.Random(4)
    rows = [r for conv in range(80) for r in some_turns(g, conv, g.choice([1, 3, 9]))] + some_turns(g, None, 20)
    df = frame(spark, rows)
    con = duckdb.connect()
    con.register("conversations", df.select("conv_id", "turn", "role", "text").toArrow())
    want = con.execute(turnrepair.SQL).fetchall()
    assert sorted(map(repr, want)) == sorted(map(repr, map(tuple, turnrepair.digest(turnrepair.damaged(df), df).collect())))
