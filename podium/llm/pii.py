"""Personal data by bootstrapped contextual extraction (built-in expressions only).

Fixed patterns give the seed entities.  The word before a seed is a lexical pattern
of its kind; patterns and the entities they stand before form a graph over which
scores are passed on a few times.  A pattern that mostly leads to entities of one
kind then also marks digit- or @-bearing runs that the fixed patterns miss.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.bloom import Bloom
from podium.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")

#: The base patterns (matched leftmost, not overlapping, per kind) and what must hold for a match.
#: Loops are possessive where what follows them can never begin inside them: the matches are the same, and a run of
#: any length is matched in a loop, not by recursion, and in time linear in its length.
PATTERNS = {
    # a match starts at the head of a run of local-part characters, or where the last match ended: elsewhere the
    # head of that run would have matched before, so the search needs not start again inside it
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests that a text without any match fails.
GATES = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
#: Runs of words with a digit or an @ sign: what a pattern may discover.
RUN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20[^\s0-9@]*+[0-9@]\S*+)*+"
#: What a discovered run must look like.
SHAPES = {"email": (r"(?s)@.*[A-Za-z]",), "ip": (r"^[^A-Za-z]*+$", r"[0-9][.,:][0-9]++[.,:][0-9]"),
          "card": (r"^(?:[^0-9A-Za-z]*+[0-9]){12,}+[^0-9A-Za-z]*+$",),
          "phone": (r"^(?:[^0-9A-Za-z]*+[0-9]){7,15}+[^0-9A-Za-z]*+$",)}
EDGE = r"^[\p{Punct}&&[^+(]]++|(?:\G|(?<![\p{Punct}&&[^)]]))[\p{Punct}&&[^)]]++$"
#: The last word of a text.
LAST_WORD = r"(?<!\S)(\S++)\s*+$"

#: What is trimmed off a piece of a run that was cut at a base span.
CUT_HEAD, CUT_TAIL = r"^[\s\p{Punct}&&[^+(]]++", r"(?<![\s\p{Punct}&&[^)]])[\s\p{Punct}&&[^)]]++$"

MIN_SEEDS = 3
ACCEPT = 0.5
#: Parts of the hashes of following words: one in so many is counted, last all of them.
FOLLOWER_PARTS = (32, 1)
ROUNDS = 3

SPAN = "struct<kind:int,start:int,end:int>"


def _positions(text: Column, regex: str, gate: Column) -> tuple[Column, Column]:
    """Matches of ``regex`` and the pieces of text around them; both empty where the gate fails."""
    none = F.array().cast("array<string>")
    return (F.when(gate, F.regexp_extract_all(text, F.lit(regex), F.lit(0))).otherwise(none),
            F.when(gate, F.split(text, regex, -1)).otherwise(none))


def _starts(matches: Column, pieces: Column) -> Column:
    """Code point at which each match starts: lengths of all that stands before it."""
    steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches,
                       lambda p, m: F.struct(F.char_length(p).alias("p"), F.char_length(m).alias("m")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(steps, zero, lambda acc, s: F.struct(
        (acc["at"] + s["p"] + s["m"]).alias("at"), F.concat(acc["out"], F.array(acc["at"] + s["p"])).alias("out")))["out"]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        x = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = x * 2 - F.when(x > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    if kind == "ip":
        return ~F.exists(F.split(m, r"\."), lambda p: ~p.rlike(r"^0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5]|)$"))
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def _base(text: Column, kind: str) -> Column:
    """array<SPAN> of the base matches of one kind."""
    k = KINDS.index(kind)
    matches, pieces = _positions(text, PATTERNS[kind], GATES[kind](text))
    found = F.zip_with(matches, _starts(matches, pieces), lambda m, s: F.struct(
        F.lit(k).alias("kind"), s.alias("start"), (s + F.char_length(m)).alias("end"), m.alias("m")))
    good = F.filter(found, lambda x: _holds(kind, x["m"]))
    return F.transform(good, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def _runs(text: Column) -> Column:
    """array<struct<start, end, run, left>>: digit- or @-bearing runs and the word before each."""
    matches, pieces = _positions(text, RUN, text.rlike("[0-9@]"))
    before = F.slice(pieces, F.lit(1), F.size(matches))
    lefts = F.transform(before, lambda p: F.lower(F.regexp_extract(p, LAST_WORD, 1)))
    core = F.transform(matches, lambda m: F.regexp_replace(m, EDGE, ""))
    heads = F.transform(matches, lambda m: F.char_length(m) - F.char_length(F.regexp_replace(m, r"^[\p{Punct}&&[^+(]]++", "")))
    placed = F.arrays_zip(_starts(matches, pieces).alias("s"), core.alias("c"), heads.alias("h"), lefts.alias("l"))
    found = F.transform(placed, lambda x: F.struct(
        (x["s"] + x["h"]).alias("start"), (x["s"] + x["h"] + F.char_length(x["c"])).alias("end"),
        x["c"].alias("run"), x["l"].alias("left")))
    return F.filter(found, lambda x: (x["left"] != "") & (x["run"] != ""))


def _units(scanned: DataFrame) -> DataFrame:
    """(text_key, left, start, end, run, seed, first): runs cut at the base spans that they meet.

    A unit is a base span (``seed`` is its kind) or what lies between such (seed -1); ``first`` marks the one
    that stands right after the left word.
    """
    r = F.col("r")
    met = F.array_sort(F.transform(
        F.filter("base", lambda b: (b["start"] < r["end"]) & (b["end"] > r["start"])),
        lambda b: F.struct(b["start"].alias("start"), (-b["end"]).alias("back"), b["kind"].alias("kind"))))
    kind = "array<struct<start:int,end:int,seed:int>>"

    def piece(start: Column, end: Column, seed: Column) -> Column:
        return F.when(start < end, F.array(F.struct(start.alias("start"), end.alias("end"), seed.alias("seed")))) \
            .otherwise(F.array()).cast(kind)

    def step(acc: Column, b: Column) -> Column:
        end = F.least(-b["back"], r["end"])
        begin = F.greatest(acc["at"], b["start"])
        return F.struct(F.greatest(acc["at"], end).alias("at"), F.concat(
            acc["out"], piece(acc["at"], b["start"], F.lit(-1)), piece(begin, end, b["kind"])).alias("out"))

    zero = F.struct(r["start"].alias("at"), F.array().cast(kind).alias("out"))
    done = F.aggregate("met", zero, step, lambda acc: F.concat(acc["out"], piece(acc["at"], r["end"], F.lit(-1))))
    cut = scanned.filter(F.size("runs") > 0).select("text_key", "base", F.explode("runs").alias("r")) \
        .select("text_key", "r", met.alias("met")).select("text_key", "r", F.explode(done).alias("u"))
    raw = F.substring(r["run"], F.col("u.start") - r["start"] + 1, F.col("u.end") - F.col("u.start"))
    whole = F.col("u.seed") >= 0
    late = F.regexp_replace(raw, CUT_HEAD, "")
    start = F.col("u.start") + F.when(whole, 0).otherwise(F.char_length(raw) - F.char_length(late))
    run = F.when(whole, raw).otherwise(F.regexp_replace(late, CUT_TAIL, ""))
    return cut.select("text_key", "r.left", start.alias("start"), (start + F.char_length(run)).alias("end"),
                      run.alias("run"), "u.seed", (F.col("u.start") == r["start"]).alias("first")).filter("run <> ''")


def _followers(source: DataFrame, lefts: DataFrame, part: int) -> DataFrame:
    """(left, n): how many different words without digits or @ follow each left word, over all texts.

    Words whose hash is divisible by ``part`` only; pairs with other left words are dropped
    inside the projection and pairs are made distinct in the tasks before they are shuffled.
    """
    bloom = Bloom(lefts, "left")
    words = F.split(F.lower("__text"), r"\s+")
    pairs = F.arrays_zip(F.col("w").alias("left"), F.slice("w", F.lit(2), F.size("w")).alias("next"))

    def wanted(p: Column) -> Column:
        inside = (p["next"] != "") & bloom.may_hold(p["left"]) & ~p["next"].rlike("[0-9@]")
        return (F.pmod(F.xxhash64(p["next"]), F.lit(part)) == 0) & inside if part > 1 else inside

    kept = source.select(words.alias("w")).select(F.explode(F.filter(pairs, wanted)).alias("p")).select("p.left", "p.next")
    return kept.distinct().groupBy("left").agg(F.count(F.lit(1)).alias("n"))


def _patterns(scanned: DataFrame, source: DataFrame) -> DataFrame:
    """(kind, left) of the patterns accepted after the scores have been passed on."""
    # an edge for each pattern and instance, with the kind of the instance where it is a seed
    edges = materialise(_units(scanned).filter("first").groupBy("left", "run").agg(F.max("seed").alias("seed")), "pii-edges")
    told = edges.groupBy("left").agg(F.count(F.lit(1)).alias("n_runs"), F.count_if(F.col("seed") >= 0).alias("seeds"))
    lefts = materialise(told.filter(F.col("seeds") >= MIN_SEEDS).select("left", "n_runs"), "pii-lefts")
    # a pattern's score is no more than its runs to all that follows it.  The words that follow it, counted in one
    # part of their hashes after another, rule out most patterns long before all their followers are counted
    for part in FOLLOWER_PARTS:
        if lefts.isEmpty():
            return lefts.select(F.lit(0).alias("kind"), "left").limit(0)
        seen = materialise(lefts.select("left", "n_runs").join(_followers(source, lefts, part), "left", "left").select(
            "left", "n_runs", F.coalesce("n", F.lit(0)).alias("n")), "pii-words")
        lefts = seen.filter(F.col("n_runs") >= ACCEPT * (F.col("n_runs") + F.col("n")))
    seen = lefts.select("left", (F.col("n_runs") + F.col("n")).alias("times"))
    edges = materialise(edges.join(lefts, "left", "left_semi"), "pii-edges")
    kinds = F.explode(F.array(*[F.lit(k) for k in range(len(KINDS))]))
    graph = edges.withColumn("kind", kinds)
    score = graph.withColumn("s", (F.col("seed") == F.col("kind")).cast("double"))
    for step in range(ROUNDS):
        told = score.groupBy("left", "kind").agg(F.sum("s").alias("sum"),
                                                 F.sum((F.col("seed") == F.col("kind")).cast("int")).alias("seeds"))
        pattern = told.join(seen, "left").withColumn("p", F.least(F.lit(1.0), F.col("sum") / F.col("times")))
        if step == ROUNDS - 1:
            break
        heard = graph.join(pattern.select("left", "kind", "p"), ["left", "kind"]).groupBy("run", "kind") \
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("p"), F.lit(1e-9)))))).alias("h"))
        score = materialise(graph.join(heard, ["run", "kind"]).withColumn(
            "s", F.when(F.col("seed") == F.col("kind"), 1.0).when(F.col("seed") >= 0, 0.0).otherwise(F.col("h")))
            .drop("h"), f"pii-score-{step}")
    return pattern.filter((F.col("p") >= ACCEPT) & (F.col("seeds") >= MIN_SEEDS)).select("kind", "left")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data in every whole text.

    Returns id, ``text_key`` (hash of id and text), ``base`` and ``spans``: sorted
    array<struct<kind, start, end>> of the fixed patterns' matches, and of these and
    the discovered ones (code points, end exclusive; kind is an index of KINDS).  A
    discovered run has the right shape, overlaps no other span, and follows a pattern
    of its kind; a run that meets base spans is cut at them first.  A pattern's score
    counts the different things that follow it, so copies of a text do not weaken it.
    Null and empty texts have no spans; repeated rows and null ids give
    one row each; an empty table gives none; other columns are ignored.
    """
    text = F.col("__text")
    source = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    scanned = source.select(
        "__id", F.xxhash64("__id", "__text").alias("text_key"),
        F.concat(*[_base(text, k) for k in KINDS]).alias("base"), _runs(text).alias("runs"))
    scanned = materialise(scanned, "pii-scan")
    patterns = materialise(_patterns(scanned, source), "pii-patterns")
    free = _units(scanned).filter("seed < 0")
    shape = F.lit(False)
    for k, kind in enumerate(KINDS):
        fits = reduce(and_, [F.col("run").rlike(p) for p in SHAPES[kind]])
        shape = F.when(F.col("kind") == k, fits).otherwise(shape)
    marked = free.join(patterns, "left").filter(shape).groupBy("text_key", "start", "end").agg(F.min("kind").alias("kind"))
    added = marked.groupBy("text_key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    return scanned.join(added, "text_key", "left").select(
        F.col("__id").alias(id_col), "text_key", F.sort_array("base").alias("base"),
        F.sort_array(F.concat("base", F.coalesce("more", F.array().cast(f"array<{SPAN}>")))).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, of the first's kind."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"])), F.get(names, s["kind"]))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(ordered, zero, step)
    return F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.char_length(text)))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base matches by kind, digest of the base spans, all spans as text, and how many were discovered."""
    found = find(docs, id_col, text_col)
    return found.select(
        id_col, *[F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(F.encode(spans_text(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def _of_kind(k: int):
    return lambda b: b["kind"] == k


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the spans of ``find`` replaced in the text (``chars_col`` follows if there is one)."""
    found = find(docs, id_col, text_col).groupBy("text_key").agg(F.first("spans").alias("__spans")) \
        .filter(F.size("__spans") > 0).withColumnRenamed("text_key", "__key")
    rows = docs.withColumn("__key", F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))) \
        .join(found, "__key", "left")
    rows = rows.withColumn(text_col, F.when(F.col("__spans").isNull(), F.col(text_col))
                           .otherwise(masked(F.col(text_col), F.col("__spans"))))
    if chars_col in docs.columns:
        rows = rows.withColumn(chars_col, F.when(F.col("__spans").isNull(), F.col(chars_col))
                               .otherwise(F.char_length(text_col).cast(dict(docs.dtypes)[chars_col])))
    return rows.select(*docs.columns)
