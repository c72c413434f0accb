import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from squall.llm import graytree


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(words, distance=2):
    root = {w: w for w in words}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in words:
        for b in words:
            if a < b and (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {w: find(w) for w in words}


def clustered(g, n):
    """Words in balls around few centres, with far ones between."""
    centres = [g.getrandbits(64) for _ in range(max(1, n // 20))]
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        w = g.choice(centres) if g.random() < 0.8 else g.getrandbits(64)
        for b in g.sample(range(64), g.randint(0, 4)):
            w ^= 1 << b
        out.add(w)
    return list(out)


def test_fingerprints_follow_the_definition():
    for text in (None, "", " \t\n", "one", "Two Words", "É is not é but A is a", "a b c d e f g a b c a b c", "x y z w v", "w " * 70000):
        assert graytree.fingerprint(None if text is None else text.encode()) == (plain_fingerprint(text) if len(text or "") < 10000 else
                                                                                 plain_fingerprint("w w w")), text
    g = random.Random(1)
    for _ in range(200):
        text = "".join(g.choice("abAB  \n\x0b\x1cé.") for _ in range(g.randint(0, 60)))
        assert graytree.fingerprint(text.encode()) == plain_fingerprint(text), repr(text)


def test_tree_finds_exactly_the_words_within_the_distance():
    g = random.Random(2)
    for n in (2, 3, 9, 64, 65, 700):
        words = np.array(clustered(g, n), np.uint64)
        asked = np.array(clustered(g, 50) + words[:20].tolist(), np.uint64)
        for distance in (0, 1, 2, 5):
            q, at = graytree.Tree(words).within(asked, distance)
            want = {(i, j) for i, a in enumerate(asked.tolist()) for j, b in enumerate(words.tolist()) if (a ^ b).bit_count() <= distance}
            assert len(q) == len(want) and set(zip(q.tolist(), at.tolist())) == want


def test_gray_rank_orders_gray_code(spark):
    codes = [i ^ (i >> 1) for i in range(200)] + [(1 << 64) - 1, 1 << 63]
    df = spark.createDataFrame([(np.uint64(c).astype(np.int64).item(),) for c in codes], "fp long")
    got = [r[0] % (1 << 64) for r in df.orderBy(graytree.gray_rank(F.col("fp"))).collect()]

    def rank(c):
        r = 0
        while c:
            r ^= c
            c >>= 1
        return r

    assert got == sorted(codes, key=rank) and got[:200] == codes[:200]


def test_links_over_several_levels_join_what_brute_force_joins(spark, monkeypatch):
    monkeypatch.setattr(graytree, "BLOCK", 8)
    monkeypatch.setattr(graytree, "FAN", 3)
    words = clustered(random.Random(3), 400)
    signed = {w: np.uint64(w).astype(np.int64).item() for w in words}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    found = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in graytree.links(df).collect()]
    want = plain_components(words)
    root = {w: w for w in words}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in found:
        assert want[u] == want[v]
        root[find(u)] = find(v)
    assert {frozenset(w for w in words if find(w) == r) for r in map(find, words)} == \
        {frozenset(w for w in words if want[w] == r) for r in set(want.values())}
    assert graytree.links(df.where("false")).count() == 0


def test_forest_has_fewer_edges_than_members():
    u, v = (np.array(x) for x in zip(*[(i, j) for i in range(30) for j in range(i)]))
    a, b = graytree.forest(u, v)
    assert sorted(a.tolist()) == list(range(1, 30)) and set(b.tolist()) == {0}
    a, b = graytree.forest(np.arange(100), np.arange(1, 101))
    assert len(a) == 100 and set(b.tolist()) == {0}


def test_documents_against_brute_force(spark, documents):
    g = random.Random(4)
    vocabulary = ["".join(g.choice("abcdefg") for _ in range(4)) for _ in range(300)]
    rows = []
    for i in range(120):
        words = [g.choice(vocabulary) for _ in range(g.choice([1, 2, 3, 40, 200]))]
        rows.append((i, " ".join(words)))
        if i % 3 == 0 and len(words) > 30:
            words[g.randrange(len(words))] = "changed"
            rows.append((1000 - i, " ".join(words)))
    rows += [(2000, None), (2001, ""), (2002, "\n "), (500, rows[5][1]), (None, rows[5][1]), (None, "of its own nobody knows"), (7, "id seven again with other words"),
             (3000, "long " * 100_000)]
    got = graytree.near_duplicates(documents(rows)).collect()
    assert len(got) == len(rows)
    fps = [plain_fingerprint(t) if len(t or "") < 10_000 else plain_fingerprint("long long long") for _, t in rows]
    parts = plain_components(list(set(fps)))
    least = {}
    for (d, _), f in zip(rows, fps):
        if d is not None:
            least[parts[f]] = min(least.get(parts[f], d), d)
    want = sorted((str(d), f"{f:016x}", str(least.get(parts[f]))) for (d, _), f in zip(rows, fps))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want
    assert len({c for _, _, c in want}) < len(set(fps))
    assert graytree.near_duplicates(documents(rows).where("false")).count() == 0
