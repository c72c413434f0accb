import math
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from squall.llm import mixing


def plain_targets(sizes, weights, total, most=2.0):
    """Share by weight, one source after the other in the order in which they fill."""
    caps = [most * s for s in sizes]
    left, weight, out = total, float(sum(weights)), [0.0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: caps[i] / weights[i]):
        out[i] = min(caps[i], left * weights[i] / weight)
        left, weight = left - out[i], weight - weights[i]
    return out


def test_targets_share_by_weight_up_to_the_cap(spark, documents):
    g = random.Random(1)
    for n in (1, 2, 9, 40):
        sizes = [g.choice([0, 1, g.randint(0, 60), g.randint(0, 500)]) for _ in range(n)]
        docs = documents([(i, "w " * s, "en", f"s{i:03d}") for i, s in enumerate(sizes)])
        got = {r["name"]: r["target"] for r in mixing.Mix(docs, cells=4).sources.collect()}
        want = plain_targets(sizes, [[5, 2, 1][i % 3] for i in range(n)], 1.5 * sum(sizes))
        assert np.allclose([got[f"s{i:03d}"] for i in range(n)], want)


def test_draws_meet_the_quotas():
    quotas, totals = [5000, 1, 0, 300], mixing.even_totals(5301, 16)
    assert sum(totals) == 5301 and len(set(totals[:-1])) == 1
    got = mixing.draws(quotas, totals, [1])
    assert got.sum(axis=0).tolist() == quotas and got.sum(axis=1).tolist() == totals
    assert (got == mixing.draws(quotas, totals, [1])).all()
    assert mixing.draws([], [0, 0], [1]).shape == (2, 0)


def corpus():
    g = random.Random(3)
    rows = [(i, " ".join(f"w{i}.{j}" for j in range(g.choice([1, 5, 40, 300]))), "en", g.choice(["big", "big", "big", "mid", "é", None])) for i in range(150)]
    return rows + [(900, None, "en", "big"), (901, "", None, "mid"), (902, " \n", "en", "nothing"), (None, "no id here", "en", "mid"), (7, "a second text of that id", "en", "mid")]


def test_every_source_meets_its_target_and_no_document_exceeds_twice_its_size(spark, documents):
    rows = corpus()
    docs = documents(rows)
    got = mixing.Mix(docs, block_words=16, out_shards=4).digest().collect()
    assert len(got) == len(rows)
    words = {d: len((t or "").split()) for d, t, _, _ in rows if d != 7}
    assert all(r["size"] == words[r["doc_id"]] for r in got if r["doc_id"] != 7)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    source = {d: s for d, _, _, s in rows if d != 7}
    by = {}
    for r in got:
        if r["doc_id"] != 7:
            by.setdefault(source[r["doc_id"]], [r["target"], 0, r["source_size"]])[1] += r["taken"]
    for s, (target, taken, size) in by.items():
        assert abs(taken - target) <= 48 + sum(r["taken"] for r in got if r["doc_id"] == 7), s
    again = mixing.Mix(docs.repartition(3, "text"), block_words=16, out_shards=4).digest().collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_slots_fill_each_pass_before_the_next(spark, documents):
    mix = mixing.Mix(documents(corpus()), block_words=16, out_shards=4)
    slots = mix.slots().collect()
    assert len({(r["shard"], r["slot"]) for r in slots}) == len(slots) == mix.total
    uses = {}
    for r in slots:
        uses.setdefault(r["src"], {}).setdefault(r["block"], 0)
        uses[r["src"]][r["block"]] += 1
    for s in mix.sources.collect():
        counts = list(uses.get(s["src"], {}).values()) + [0] * (s["blocks"] - len(uses.get(s["src"], {})))
        assert sum(counts) == s["quota"] and (not counts or max(counts) - min(counts) <= 1)


def test_the_words_taken_are_those_of_the_placed_slots(spark, documents, monkeypatch):
    mix = mixing.Mix(documents(corpus()), block_words=16, out_shards=4)
    content = mix.mixed().collect()
    blocks = {(r["shard"], r["slot"]): (r["src"], r["block"]) for r in mix.slots().collect()}
    assert {(r["shard"], r["slot"]): (r["src"], r["block"]) for r in content} == blocks
    parts = {}
    for r in mix.pieces().collect():
        parts.setdefault((r["src"], r["block"]), []).append((r["row"], r["word"], r["n"]))
    held = {}
    for r in content:
        held.setdefault((r["shard"], r["slot"]), []).append((r["row"], r["word"], r["n"]))
    assert all(sorted(held[at]) == sorted(parts[b]) for at, b in blocks.items())
    calls = []
    mixed = mixing.Mix.mixed
    monkeypatch.setattr(mixing.Mix, "mixed", lambda self: calls.append(1) or mixed(self))
    assert sum(r["taken"] for r in mix.digest().collect()) == sum(r["n"] for r in content) and len(calls) == 1
    assert sum(r["n"] * r["uses"] for r in mix.used().collect()) == sum(r["n"] for r in content) and len(calls) == 2


def test_mixed_documents_hold_the_words_taken(spark, documents):
    docs = documents(corpus()).where("doc_id <> 7 or doc_id is null")
    out = mixing.mixed_documents(docs, block_words=16, out_shards=4).collect()
    taken = {r["doc_id"]: r["taken"] for r in mixing.Mix(docs, block_words=16, out_shards=4).digest().collect()}
    words = {}
    for r in out:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert words == {d: n for d, n in taken.items() if n}
    assert out[0].asDict().keys() == set(docs.columns)


def test_passages_join_neighbours():
    assert mixing.passages("a b  c\nd e", [(0, 2, 2), (2, 2, 1), (4, 1, 1)]) == ["a b  c\nd e", "a b"]
    assert mixing.passages("a b c", [(1, 1, 1)]) == ["b"] and mixing.passages(None, []) == []


def test_empty_table_and_limits(spark, documents):
    docs = documents(corpus())
    assert mixing.Mix(docs.where("false")).digest().count() == 0
    assert mixing.mixed_documents(docs.where("false")).count() == 0


def test_small_sources_come_near_their_targets(spark, documents):
    """Down to a few words: no source is a whole block off."""
    g = random.Random(5)
    sizes = [1, 2, 3, 5, 8, 13, 17, 40, 63, 64, 100, 832, 2000]
    rows, n = [], 0
    for i, size in enumerate(sizes):
        while size:
            part = g.randint(1, min(size, 60))
            rows.append((n, " ".join(f"w{n}.{j}" for j in range(part)), "en", f"s{i:02d}"))
            size, n = size - part, n + 1
    got = mixing.Mix(documents(rows)).digest().collect()
    taken, target = {}, {}
    for r in got:
        source = rows[r["doc_id"]][3]
        taken[source], target[source] = taken.get(source, 0) + r["taken"], r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 1 + 0.02 * target[s] for s in taken)


def test_many_sources_are_drawn_in_cells(spark, documents):
    rows = [(i, "a b c", "en", f"host{i % 300:03d}") for i in range(900)]
    mix = mixing.Mix(documents(rows), out_shards=4, cells=7)
    counts = mix.counts().collect()
    by_source, by_shard = {}, {}
    for r in counts:
        by_source[r["src"]] = by_source.get(r["src"], 0) + r["count"]
        by_shard[r["shard"]] = by_shard.get(r["shard"], 0) + r["count"]
    assert by_source == {r["src"]: r["quota"] for r in mix.sources.collect() if r["quota"]}
    assert [by_shard.get(i, 0) for i in range(4)] == mixing.even_totals(mix.total, 4)
    slots = mix.slots().collect()
    assert sorted((r["shard"], r["slot"]) for r in slots) == [(i, j) for i in range(4) for j in range(by_shard.get(i, 0))]


def plain_mix(rows, block_words, out_shards, seed="mix", weights=(5, 2, 1)):
    """Words taken of each row, in plain Python from the rows alone: streams, quotas, draws, permutations and blocks."""
    def xx(*values):
        h = 42
        for v in values:
            if v is not None:
                raw = v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True)
                h = xxhash.xxh64_intdigest(raw, h)
        return h - (1 << 64) if h >> 63 else h

    def once(x, a, b, key):
        left, right = x % a, x // a
        for turn in range(4):
            bits = xxhash.xxh64_intdigest(key.encode(), 42)
            for value, width in ((turn, 4), (right, 8)):
                bits = xxhash.xxh64_intdigest(value.to_bytes(width, "little"), bits)
            side = a if turn % 2 == 0 else b
            left, right = right, (left + (bits & ((1 << 48) - 1)) % side) % side
        return a * right + left

    def permuted(x, n, key):
        a = math.isqrt(n - 1) + 1 if n else 1
        b = max(1, -(-n // a))
        x = once(x, a, b, key)
        while x >= n:
            x = once(x, a, b, key)
        return x

    sizes = [len([w for w in re.split("[ \t-\r]+", t or "") if w]) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    held = [sum(n for n, r in zip(sizes, rows) if r[2] == s) for s in names]
    goal = plain_targets(held, [weights[i % 3] for i in range(len(names))], 1.5 * sum(held))
    widths = [max(1, min(block_words, n // 64)) for n in held]
    blocks = [-(-n // w) for n, w in zip(held, widths)]
    quotas = [min(2 * b, round(t * b / n)) if n else 0 for n, b, t in zip(held, blocks, goal)]
    per = -(-sum(quotas) // out_shards)
    totals = [max(0, min(per, sum(quotas) - per * i)) for i in range(out_shards)]
    g, left, uses = np.random.Generator(np.random.PCG64([ord(c) for c in seed])), np.array(quotas), [0] * len(names)
    taken = [0] * len(rows)
    where = []
    for s, name in enumerate(names):          # block -> (row, words) by the stream's order
        n_buckets = max(1, len(rows) // 2000)
        order = sorted((i for i in range(len(rows)) if rows[i][2] == name),
                       key=lambda i: (xx(xx(rows[i][0], rows[i][1]), 1) % n_buckets, xx(rows[i][0], rows[i][1]), i))
        parts, at = {}, 0
        for i in order:
            for w in range(at, at + sizes[i]):
                parts.setdefault(w // widths[s], []).append(i)
            at += sizes[i]
        where.append(parts)
    for total in totals:
        while total:
            got = np.minimum(g.multinomial(total, left / left.sum()), left)
            for s, n in enumerate(got.tolist()):
                for k in range(uses[s], uses[s] + n):
                    turn = xx(s, k // blocks[s]) & ((1 << 31) - 1)
                    for i in where[s][permuted((k + turn) % blocks[s], blocks[s], seed)]:
                        taken[i] += 1
                uses[s] += n
            left, total = left - got, total - int(got.sum())
    return taken


def test_words_taken_equal_a_plain_mix(spark, documents):
    rows = [(d, t, s) for d, t, _, s in corpus()]
    rows = [r for n, r in enumerate(rows) if r not in rows[:n]]
    got = mixing.Mix(documents([(d, t, "en", s) for d, t, s in rows]), block_words=16, out_shards=4).digest().collect()
    want = plain_mix(rows, 16, 4)
    sizes = [len((t or "").split()) for _, t, _ in rows]
    assert sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in got) == sorted((str(d), n, w) for (d, _, _), n, w in zip(rows, sizes, want))


def test_clashing_names_and_equal_rows_keep_their_own_parts(spark, documents):
    words = [f"w{j}" for j in range(600)]
    rows = [(1, " ".join(words), "en", "x"), (1, " ".join(words), "en", "y"), (None, " ".join(words[:300]), "en", "x"), (None, " ".join(words[:300]), "en", "x")]
    docs = documents(rows).withColumn("mark", F.lit("m")).withColumn("__doc", F.lit(4)).withColumn("doc", F.lit("d")).withColumn("parts", F.lit(1))
    out = mixing.mixed_documents(docs, block_words=8)
    assert out.columns == docs.columns
    taken = {r["name"]: r["target"] for r in mixing.Mix(docs, block_words=8).sources.collect()}
    got = {}
    for r in out.collect():
        got[r["source"]] = got.get(r["source"], 0) + len(r["text"].split())
        assert (r["mark"], r["__doc"], r["doc"], r["parts"]) == ("m", 4, "d", 1)
    assert all(abs(got[s] - t) <= 0.03 * t for s, t in taken.items())
