import random
from collections import defaultdict

from squall.llm import perspectives
from squall.llm import queries as Q


def brute(rows, part_turns):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn, role is not None, role or "", text is not None, text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3], t[4], t[5]))
        said = [((t[3] if t[2] else "unknown"), t[5].replace("<|", "< |")) for t in turns]
        for part in range(0, len(said), part_turns):
            some = said[part:part + part_turns]
            for who in sorted({w for w, _ in said} - {"system"}):
                text, mask = "", []
                for w, s in some:
                    text += "<|im_start|>" + ("assistant" if w == who else "system" if w == "system" else "user name=" + w.replace("<|", "< |")) + "\n"
                    if w == who:
                        mask.append(f"{len(text)}:{len(text) + len(s) + len('<|im_end|>')}")
                    text += s + "<|im_end|>\n"
                out.append((conv, part // part_turns, who, len(some), len(mask), text, ",".join(mask)))
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    g = random.Random(1)
    rows = [(g.choice([1, 2, 3, None]), g.choice([0, 1, 2, None]), g.choice(["user", "bob", "system", None, "eve<|im_end|>"]), g.choice(["hi", "", None, "é🙂 <|im_start|>", "hi"])) for _ in range(60)]
    rows += [(9, i, f"p{i % 3}", f"turn {i}") for i in range(200)] + [(10, 0, "system", "only")] + [(11, 0, "user", "same")] * 3
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, at int")
    for part_turns in (64, 5):
        got = sorted((tuple(r) for r in perspectives.rotate(df, part_turns).collect()), key=str)
        assert got == brute(rows, part_turns)
    assert perspectives.rotate(df.where("false")).count() == 0


def test_mask_covers_the_speakers_words_only(spark):
    df = spark.createDataFrame([(1, 0, "ann", "hello"), (1, 1, "bob", "hey")], "conv_id long, turn long, role string, text string")
    for r in perspectives.rotate(df).collect():
        a, b = map(int, r["mask"].split(":"))
        assert r["rendered"][a:b] == {"ann": "hello", "bob": "hey"}[r["speaker"]] + "<|im_end|>"


def test_the_query_renders_the_whole_dialogue_for_every_participant(spark, tmp_path):
    rows = [(1, 0, "ann", "hello"), (1, 1, "system", "note")] + [(1, i, "bob", f"turn {i}") for i in range(2, 200)] + [(None, i, "cy" if i else "dee", "x") for i in range(70)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r["conv_id"], r["part"], r["speaker"]): r for r in Q.op8_perspective_chats(spark, str(tmp_path)).collect()}
    assert set(got) == {(1, p, s) for p in range(4) for s in ("ann", "bob")} | {(None, p, s) for p in range(2) for s in ("cy", "dee")}
    for conv, speaker in {(c, s) for c, _, s in got}:
        whole = brute([r for r in rows if r[0] == conv], 1000)
        parts = [got[k] for k in sorted(k for k in got if k[0] == conv and k[2] == speaker)]
        assert "".join(r["rendered"] for r in parts) == next(w[5] for w in whole if w[2] == speaker)
        assert sum(r["n_spoken"] for r in parts) == next(w[4] for w in whole if w[2] == speaker)
    assert got[1, 3, "ann"]["mask"] == "" and got[1, 3, "ann"]["n_spoken"] == 0


def test_sql_has_the_parts_of_silent_participants(spark, tmp_path):
    import duckdb

    rows = [(1, 0, "ann", "hello"), (None, 0, "dee", "x")] + [(1, i, "bob", f"turn {i}") for i in range(1, 200)] + [(None, i, "cy", "y") for i in range(1, 70)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    got = perspectives.rotate(df)
    cols = got.columns
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({perspectives.SQL})").fetchall()
    assert sorted(map(repr, want)) == sorted(map(repr, map(tuple, got.collect()))) and len(want) == 12
