"""Near-dedup against brute force on all pairs, and the defined cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from squall.llm import minhash
from squall.llm.shingles import shingle_set, word_hashes


def brute(rows, percent=75):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])
        sets[d] = set(grams)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def varied(seed=3, groups=12, copies=9):
    g = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for _ in range(groups):
        base = [g.choice(words) for _ in range(g.randint(3, 120))]
        for _ in range(copies):
            t = list(base)
            for _ in range(g.randint(0, 3)):
                t[g.randrange(len(t))] = g.choice(words)
            rows.append((len(rows), g.choice([" ", "\n", "\t "]).join(t)))
    return rows


def test_matches_brute_force(spark, documents):
    rows = varied() + [(500, None), (501, ""), (502, " \n "), (503, "One"), (504, "one"), (505, "x " * 30000), (506, "X  " * 30000)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(documents(rows)).collect()}
    assert got == brute(rows)


def test_links_missed_by_the_smallest_document_are_found(spark, documents):
    """A chain: each text is near the next, but not near the first."""
    words = [f"c{i}" for i in range(100)]
    rows = [(i, " ".join(words[3 * i:3 * i + 60])) for i in range(8)] + [(90, " ".join(words[40:100]))]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(documents(rows)).collect()}
    assert got == {d: v[1] for d, v in brute(rows).items()}
    assert got[7] == 0


def test_rows_without_id_repeated_ids_and_empty_table(spark, documents):
    text = "a b c d e f g h"
    rows = [(None, text), (4, text), (4, "z y x w v u t"), (9, "z y x w v u t"), (7, text)]
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(documents(rows)).collect()), key=str)
    assert got == sorted([(None, None, False), (4, 4, True), (4, 4, True), (7, 4, False), (9, 4, False)], key=str)
    empty = minhash.near_duplicates(documents(rows).where("false"))
    assert empty.count() == 0 and empty.columns[:4] == ["doc_id", "n_shingles", "component_id", "kept"]


def test_min_and_max_are_those_of_the_permuted_set():
    h = shingle_set(" ".join(f"t{i}" for i in range(2000)))
    a, b = minhash._constants(16)
    x = h * a + b
    sig = minhash.signature(h, 16)
    assert (sig[0::2] == x.min(axis=1)).all() and (sig[1::2] == x.max(axis=1)).all()


def test_word_hashes_split_on_ascii_space_only():
    assert len(word_hashes("a b c\x1cd\x0be")) == 3
    assert (word_hashes("AbC dé") == word_hashes("  aBc\n\rDé")).all()
    assert (word_hashes("É") != word_hashes("é")).all()
    assert len(np.unique(word_hashes(" ".join(f"{i:x}" for i in range(20000))))) == 20000


def test_overlaps_count_intersections():
    g = np.random.default_rng(1)
    sets = [np.unique(g.integers(0, 60, n).astype(np.uint64)) for n in (5, 30, 50, 1)]
    want = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    assert (minhash.overlaps(sets, sets) == np.array(want)).all()


def test_kept_is_plain_boolean(spark, documents):
    assert minhash.near_duplicates(documents([(1, "a")])).where(F.col("kept")).count() == 1
