"""Personal data by fixed patterns and by bootstrapped contexts, with built-in functions only.

Base spans come from four patterns (``email``, ``ip``, ``card``, ``phone``) with their checks.
They are the seeds of a bootstrap: the two words before an entity are a lexical
pattern, and every other token with a digit or an at sign is a candidate instance in its own
context. Spark counts the pattern-instance graph once and scores it in rounds: a pattern's
confidence is the believed share of its occurrences, smoothed by its support; an instance's
belief is the mean confidence of its patterns, at least the share of its occurrences that
are seeds. Candidates in a pattern of at least ``CONFIDENCE`` with ``SUPPORT`` believed
occurrences are added as spans of kind ``context``.

The two words are those of the whole text before the entity, at any distance. Earlier matches
of the entity's kind, whether they pass their check or not, count as one word each; every word with a
digit or an at sign counts by its form, so lists of identifiers share their contexts.

Instances are token forms (each digit 9, letters as one ``a``), so an identifier never seen
before shares the belief in its form. Only the graph's edges are iterated on, with counts; hot
patterns and forms are folded before each shuffle. Patterns with fewer than ``SUPPORT``
occurrences can never be accepted and are left out of the graph.

Regular expressions are written so that each position of a text is looked at a bounded number of
times: words start only after white space, or where the last match ended, and repeated groups
are possessive.

Defined results: null text is empty and has no spans; rows that repeat a doc_id are separate
rows; no seeds: nothing is added; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from squall.llm import common

KINDS = ("email", "ip", "card", "phone", "context")
SPACE = r"\x20\x09-\x0D"
# The base patterns, in forms that do not backtrack over long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MAY = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]++\.[0-9]")),
    "card": lambda t: F.rlike(t, F.lit(r"[0-9](?:[\x20-]?[0-9]){13}")),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
TOKEN = rf"(?<![^{SPACE}])[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+"
LEFT = rf"(?<![^{SPACE}])[^{SPACE}]++[{SPACE}]++[^{SPACE}]++[{SPACE}]*+\z"
CONFIDENCE = 0.7
SUPPORT = 3
ROUNDS = 4

OCTET = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])$"


TOKENS = 4             # number of the kind ``context`` in KINDS


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    """Of a string of digits."""
    places = F.transform(F.split(F.reverse(s), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") >= 5, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))))
    return F.aggregate(places, F.lit(0), lambda a, d: a + d) % 10 == 0


CHECKS = {
    "email": lambda s: F.lit(True),
    "ip": lambda s: F.forall(F.split(s, r"\."), lambda p: F.rlike(p, F.lit(OCTET))),
    "card": lambda s: F.when(F.length(_digits(s)).between(14, 19), _luhn(_digits(s))).otherwise(False),
    "phone": lambda s: F.length(_digits(s)).between(10, 15),
}


def matches(hits: str, gaps: str, kind: int, check) -> Column:
    """All matches of a kind in a text: array of (kind, gap, len, ok, ctx, form, pos), empty if none passes.

    ``hits`` and ``gaps`` are columns: the matches, and the texts between them. ``gap`` is the length
    of the text since the match before; places are sums of lengths.
    """
    def described(hit: Column, i: Column) -> Column:
        ok, gap = check(hit), F.get(gaps, i)
        before = context(F.get(hits, i - 2), F.get(gaps, i - 1), F.get(hits, i - 1), gap)
        return F.struct(F.lit(kind).alias("kind"), F.length(gap).alias("gap"), F.length(hit).alias("len"), ok.alias("ok"),
                        F.when(ok, before).alias("ctx"), F.when(ok, shape(hit)).alias("form"), i.alias("pos"))

    found = F.when(F.exists(hits, check), F.transform(hits, described))
    return F.coalesce(found, F.array().cast("array<struct<kind:int,gap:int,len:int,ok:boolean,ctx:string,form:string,pos:int>>"))


def shape(token: Column) -> Column:
    """Form of a token: each digit 9, a run of letters a."""
    return F.regexp_replace(F.regexp_replace(token, "[0-9]", "9"), r"\p{L}++", "a")


def word(w: Column) -> Column:
    """A context's word: lower-cased; with a digit or an at sign its form, runs of digits as one 9."""
    return F.when(F.rlike(w, F.lit("[0-9@]")), F.regexp_replace(shape(w), "9++", "9")).otherwise(F.lower(w))


def context(hit2: Column, gap1: Column, hit1: Column, gap: Column) -> Column:
    """The two words before an entity; null if there are not two.

    From the text since the match before (``gap``), that match and what stands before it: as each match is a
    word, two matches back are enough. Null where there is no such match.
    """
    def one(hit: Column) -> Column:
        return F.regexp_replace(hit, f"[{SPACE}]++", "")

    found = F.regexp_extract(F.concat_ws(" ", one(hit2), gap1, one(hit1), gap), LEFT, 0)
    words = F.transform(F.filter(F.split(found, f"[{SPACE}]++"), lambda w: w != ""), word)
    return F.when(found != "", F.array_join(words, " "))


def scanned(docs: DataFrame) -> DataFrame:
    """(row, doc_id, found): matches of base kinds, and tokens as the last kind."""
    text, none = common.text_or_empty(), F.array().cast("array<string>")
    rules = [(PATTERNS[k], MAY[k](text), CHECKS[k]) for k in KINDS[:TOKENS]] + [(TOKEN, F.rlike(text, F.lit("[0-9@]")), lambda s: F.lit(True))]
    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                      *(F.when(may, F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none).alias(f"hits{i}") for i, (p, may, _) in enumerate(rules)),
                      *(F.when(may, F.split(text, p, -1)).otherwise(none).alias(f"gaps{i}") for i, (p, may, _) in enumerate(rules)))
    return cut.select("row", "doc_id", F.concat(*(matches(f"hits{i}", f"gaps{i}", i, check) for i, (_, _, check) in enumerate(rules))).alias("found"))


def occurrences(found: DataFrame) -> DataFrame:
    """Spans that pass their check, with places; tokens that touch a base span are left out."""
    rows = found.select("row", F.explode("found").alias("m")).select("row", "m.*")
    running = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (rows.withColumn("stop", F.sum(F.col("gap") + F.col("len")).over(running).cast("int"))
             .where("ok").select("row", "kind", (F.col("stop") - F.col("len")).alias("start"), "stop", "ctx", "form"))
    base = F.col("kind") < TOKENS
    # A base span that starts no later and ends after the token starts, or one that starts inside it.
    earlier = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (spans.withColumn("reach", F.max(F.when(base, F.col("stop"))).over(earlier))
             .withColumn("next", F.min(F.when(base, F.col("start"))).over(later)))
    touched = F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("next") < F.col("stop"), F.lit(False))
    return spans.where(base | ~touched).select("row", "kind", "start", "stop", "ctx", "form")


def patterns(spans: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """Contexts (ctx, conf, believed) that the rounds accept."""
    seed = (F.col("kind") < TOKENS).cast("long")
    edges = spans.where("ctx is not null").groupBy("ctx", "form").agg(F.sum(seed).alias("seeds"), F.count("*").alias("n"))
    often = edges.groupBy("ctx").agg(F.sum("n").alias("m")).where(F.col("m") >= support).select("ctx")
    edges = common.stored(edges.join(often, "ctx"), "pii-edges")
    share = edges.groupBy("form").agg((F.sum("seeds") / F.sum("n")).alias("share"))
    belief = share.select("form", F.col("share").alias("belief"))
    scored = None
    for turn in range(rounds):
        believed = F.col("seeds") + (F.col("n") - F.col("seeds")) * F.col("belief")
        scored = common.stored(edges.join(belief, "form").groupBy("ctx").agg(F.sum(believed).alias("believed"), F.sum("n").alias("m"))
                               .select("ctx", (F.col("believed") / (F.col("m") + 1)).alias("conf"), "believed"), "pii-patterns")
        if turn + 1 < rounds:
            mean = edges.join(scored, "ctx").groupBy("form").agg((F.sum(F.col("n") * F.col("conf")) / F.sum("n")).alias("mean"))
            belief = common.stored(mean.join(share, "form").select("form", F.greatest("mean", "share").alias("belief")), "pii-forms")
    return scored.where((F.col("conf") >= confidence) & (F.col("believed") >= support))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context."""
    found = common.stored(scanned(docs), "pii-found")
    spans = common.stored(occurrences(found), "pii-spans")
    good = patterns(spans).select(F.col("ctx").alias("good"))
    base = F.col("kind") < TOKENS
    kept = (spans.where(base).drop("ctx", "form")
            .unionByName(spans.where(~base).join(good, F.col("ctx") == F.col("good"), "left_semi").drop("ctx", "form")))
    listed = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "stop"))).alias("list"))
    names = F.array(*(F.lit(k) for k in KINDS))

    def text_of(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    rows = (found.select("row", "doc_id").join(listed, "row", "left")
            .select("doc_id", F.coalesce("list", F.array().cast("array<struct<start:int,kind:int,stop:int>>")).alias("list")))

    def number(kind: int) -> Column:
        return F.size(F.filter("list", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [number(i) for i in range(len(KINDS))]
    return rows.select("doc_id", *counts[:TOKENS], F.sha2(text_of(F.filter("list", lambda s: s["kind"] < TOKENS)), 256).alias("base_sha256"),
                       text_of(F.col("list")).alias("spans"), counts[TOKENS])
