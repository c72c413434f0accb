import random

from pyspark.sql import functions as F

from squall.llm import decontam


def distance(pattern, text):
    """Smallest edit distance of pattern to any passage of text, and the first end, by the full table."""
    row = list(range(len(pattern) + 1))
    best = (row[-1], 0)
    for j, c in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        if row[-1] < best[0]:
            best = (row[-1], j)
    return best


def test_myers_equals_the_full_table():
    g = random.Random(2)
    for _ in range(300):
        p = "".join(g.choice("abc") for _ in range(g.randint(1, 90)))
        t = "".join(g.choice("abc") for _ in range(g.randint(0, 150)))
        want = distance(p, t)
        got = decontam.myers(p, t, len(p) - 1)
        assert got == (want if want[0] < len(p) and t else None)


def test_pieces_cover_the_item():
    for n, k in ((40, 3), (7, 6), (5, 0)):
        item = "".join(chr(97 + i % 26) for i in range(n))
        got = decontam.pieces(item, k)
        assert len(got) == k + 1 and "".join(p for _, p in got) == item and all(item[a:a + len(p)] == p for a, p in got)


def edited(g, text, n):
    t = list(text)
    for _ in range(n):
        i = g.randrange(len(t))
        t[i:i + 1] = g.choice([[], ["x"], [t[i], "y"]])
    return "".join(t)


def test_all_passages_within_budget_are_found(spark, documents):
    g = random.Random(7)
    word = lambda: "".join(g.choice("etaoinshr") for _ in range(g.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(g.randint(8, 40)))) for i in range(15)]
    rows = []
    for d in range(120):
        body = [word() for _ in range(g.randint(0, 200))]
        if d % 3:
            _, item = g.choice(items)
            k = decontam.budget(len(item))
            body.insert(g.randint(0, len(body)), edited(g, item, g.choice([0, 1, k, k + 1, 3 * k + 4])))
        rows.append((d, " \n".join(body).upper() if d % 2 else " ".join(body)))
    rows += [(500, None), (501, ""), (502, items[0][1]), (502, items[0][1]), (503, ("x " * 40000) + items[1][1])]
    bench = spark.createDataFrame([*items, (77, None), (78, ""), (79, "tiny"), (3, items[3][1])], "item_id long, text string")
    want = {}
    for d, t in rows:
        for i, item in items:
            p, text = decontam.normal(item), decontam.normal(t)
            if len(text) > 60000:
                if i == 1:
                    want[(d, i)] = 0
                continue
            best = distance(p, text)[0]
            if best <= decontam.budget(len(p)):
                want[(d, i)] = best
    for size in (200_000, 30):
        got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontam.contaminated(documents(rows), bench, size=size).collect()}
        assert got == want
    clean = decontam.without(documents(rows).withColumn("n", F.monotonically_increasing_id()), bench, size=30).collect()
    assert sorted(map(str, {r["doc_id"] for r in clean})) == sorted(map(str, {d for d, _ in rows} - {d for d, _ in want}))
    assert len([v for v in want.values() if v]) > 5


def test_short_items_match_between_word_edges_and_empty_tables(spark, documents):
    bench = spark.createDataFrame([(1, "Yes."), (2, "short question?")], "item_id long, text string")
    docs = documents([(1, "yes."), (2, "oh yes. indeed"), (3, " YES. "), (4, "eyes. wide"), (5, "a Short\nquestion? inside"), (6, "short questions"), (7, "yes.no (yes.) eyes.")])
    assert sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()) == [(1, 1), (2, 1), (3, 1), (5, 2), (7, 1)]
    assert decontam.contaminated(docs, bench.where("false")).count() == 0
    assert decontam.contaminated(docs.where("false"), bench).count() == 0


def test_repeated_hits_take_linear_time():
    import time

    item = "what is the capital city of the northern province today"
    m = decontam.Matcher([(1, item)], decontam.ERROR_RATE)
    near = "what is the capital town of the southern province today "       # shares pieces, beyond the budget

    def took(n):
        text, at = near * n, time.perf_counter()
        assert m.find(text) == {}
        return time.perf_counter() - at

    took(100)
    small, large = took(2_000), took(20_000)
    assert large < 40 * small + 1
    assert m.find(near * 500 + item.replace("city", "cyty") + " " + near * 500)[1][0] == 1
