"""Text lines to typed records.

A layout is data: a list of ``Field`` rows saying where each output field sits
relative to the dictionary token (the country code in the reference's sheets).
``parse_layout`` turns all layouts into one projection of built-in array
expressions, with a ``CASE`` on the routed layout name, so a multi-layout
file set is parsed in a single pass with no Python worker.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from podium.functions.bloom import Bloom
from podium.functions.text import (first_in, first_pos_in, flag_priority, item, join_range,
                                   paren_capture, tail, tokenize)

from podium.fixed import (DATE_PATTERN, EVENT_PATTERN, HEADER_DEFAULTS, LOCATION_MARK, ROUND_PATTERN,
                          SPECIAL_CODES)
from podium.operators.skew import left_join_even
from podium.session import scratch_path, written

RECORD_FIELDS = ("rank", "bib", "name", "code", "heat", "lane", "pos", "time", "ms", "wind",
                 "result", "info")


@dataclass(frozen=True)
class Field:
    """Where one output field comes from.

    kind: ``abs`` token at ``offset``; ``rel`` token at code position + ``offset``
    (``alt`` instead when a bracket value is present); ``name`` tokens 2 .. code-1
    joined; ``const`` / ``null``; ``bracket`` first ``(...)`` in the tail;
    ``flag`` first of ``codes`` present in the tail from ``offset``;
    ``first_code`` first tail token listed in ``codes``; ``if_rank`` ``value``
    when the first token is ``'1'``.
    """

    name: str
    kind: str
    offset: int = 0
    alt: int | None = None
    value: str | None = None
    codes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Layout:
    name: str
    fields: tuple[Field, ...]
    bracket_from: int | None = None


def _common(*rest: Field) -> tuple[Field, ...]:
    return (Field("rank", "abs", 0), Field("bib", "abs", 1), Field("name", "name"),
            Field("code", "rel", 0), *rest)


# The reference's three sheet layouts.
HEATS = Layout("heats", _common(
    Field("heat", "rel", 1), Field("lane", "rel", 2), Field("pos", "rel", 3), Field("time", "rel", 4),
    Field("ms", "bracket"), Field("wind", "rel", 5, alt=6),
    Field("result", "flag", 6, codes=("Q", "q")), Field("info", "first_code", 6, codes=SPECIAL_CODES),
), bracket_from=4)
FINAL_A = Layout("final_a", _common(
    Field("heat", "null"), Field("lane", "rel", 1), Field("pos", "null"), Field("time", "rel", 2),
    Field("ms", "bracket"), Field("wind", "const", value="+1.0"),
    Field("result", "if_rank", value="Q"), Field("info", "first_code", 3, codes=SPECIAL_CODES),
), bracket_from=3)
FINAL_B = Layout("final_b", _common(
    Field("heat", "null"), Field("lane", "rel", 5), Field("pos", "rel", 6), Field("time", "rel", 8),
    Field("ms", "null"), Field("wind", "rel", 7),
    Field("result", "if_rank", value="Q"), Field("info", "if_rank", value="NR"),
))


def explode_lines(df: DataFrame, text_col: str, sep: str = "\n", line_col: str = "line",
                  pos_col: str = "line_no") -> DataFrame:
    """One row per line, 0-based position kept (A3); other columns carried."""
    rest = [c for c in df.columns if c != text_col]
    return df.select(*rest, F.posexplode(F.split(F.col(text_col), sep, -1)).alias(pos_col, line_col))


def base_name(path: Column) -> Column:
    """Lower-case file name of a path, percent-encoded or plain."""
    name = F.substring_index(F.substring_index(path, "/", -1), "\\", -1)
    decoded = F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)
    return F.lower(F.when(F.contains(name, F.lit("%")), decoded).otherwise(name))


def route_layout(path: Column, routes: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Layout name from the file's base name by LIKE patterns, first match wins (A1)."""
    path = base_name(path)
    out = None
    for pattern, layout in routes:
        cond = path.like(pattern)
        out = F.when(cond, F.lit(layout)) if out is None else out.when(cond, F.lit(layout))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out


def dict_tokens(df: DataFrame, tokens: str, dictionary: DataFrame, pos: str, hits: str | None = None) -> DataFrame:
    """``df`` with the 0-based position of the first token that a dictionary table holds (B4), and how many it holds.

    For a dictionary of any size: a Bloom filter of bounded size drops most other
    tokens inside the projection; the lines with tokens left are told apart by a hash
    of their tokens (equal lines share their answer), these tokens are semi-joined to
    the words with hot tokens spread out, and ``min(pos)`` a line is joined back.
    Lines without a candidate enter no join with a key.
    """
    words = dictionary.select(F.col(dictionary.columns[0]).alias("__tok")).filter("__tok IS NOT NULL").distinct()
    bloom = Bloom(words, "__tok")

    def may(t: Column) -> Column:
        return t.isNotNull() & bloom.may_hold(t)

    placed = F.transform(tokens, lambda t, i: F.struct(t.alias("__tok"), i.alias("__at")))
    cand = F.filter(placed, lambda x: may(x["__tok"]))
    some = F.exists(tokens, may)
    line = {f"__l{i}": F.when(some, F.xxhash64(F.lit(i), tokens)) for i in range(2)}
    keys = list(line)
    lines = df.filter(some).select(*[c.alias(n) for n, c in line.items()], cand.alias("__c")).dropDuplicates(keys)
    left = lines.select(*keys, F.inline("__c"))
    held = left_join_even(left, words.withColumn("__in", F.lit(True)), ["__tok"]).filter("__in")
    first = held.groupBy(*keys).agg(F.min("__at").cast("int").alias(pos), F.count(F.lit(1)).cast("int").alias("__hits"))
    joined = left_join_even(df.withColumns(line), first, keys).drop(*keys)
    return joined.withColumnRenamed("__hits", hits) if hits else joined.drop("__hits")


#: A dictionary table with no more words than this becomes a literal set, as a small table of a join is broadcast.
LITERAL_WORDS = 5000


def _as_literal(dictionary: Iterable[str] | DataFrame) -> list[str] | None:
    """The words as a list, if it is one or is a table that passes the size check; else the table must be joined."""
    if not isinstance(dictionary, DataFrame):
        return list(dictionary)
    word = F.col(dictionary.columns[0])
    rows = dictionary.select(word.alias("w")).filter(word.isNotNull()).distinct().limit(LITERAL_WORDS + 1).collect()
    return sorted(r["w"] for r in rows) if len(rows) <= LITERAL_WORDS else None


def dict_token_pos(df: DataFrame, tokens: str, dictionary, out: str = "pos") -> DataFrame:
    """0-based position of the first token found in ``dictionary``.

    A list, or a table that passes a size check, becomes an IN-set inside the projection;
    a table of any other size is joined (``dict_tokens``), with the same answer.
    """
    words = _as_literal(dictionary)
    if words is None:
        return dict_tokens(df, tokens, dictionary, out).select(*df.columns, out)
    return df.withColumn(out, first_pos_in(tokens, words))


def _field_expr(f: Field, p: Column, i: Column, bracket: Column) -> Column:
    if f.kind == "abs":
        return item(p, f.offset)
    if f.kind == "rel":
        main = item(p, i + f.offset)
        return main if f.alt is None else F.when(bracket.isNotNull(), item(p, i + f.alt)).otherwise(main)
    if f.kind == "name":
        return F.when(F.size(p) > 2, join_range(p, 2, i))
    if f.kind == "const":
        return F.lit(f.value)
    if f.kind == "null":
        return F.lit(None).cast("string")
    if f.kind == "bracket":
        return bracket
    if f.kind == "flag":
        return flag_priority(tail(p, i + f.offset), f.codes)
    if f.kind == "first_code":
        return first_in(tail(p, i + f.offset), f.codes)
    if f.kind == "if_rank":
        return F.when(item(p, 0) == F.lit("1"), F.lit(f.value))
    raise ValueError(f"unknown field kind {f.kind}")


def _bracket_expr(layout: Layout, p: Column, i: Column) -> Column:
    if layout.bracket_from is None:
        return F.lit(None).cast("string")
    return paren_capture(F.array_join(tail(p, i + layout.bracket_from), " "))


def _layout_exprs(layout: Layout, p: Column, i: Column, bracket: Column) -> dict[str, Column]:
    return {f.name: _field_expr(f, p, i, bracket).cast("string") for f in layout.fields}


def parse_layout(lines: DataFrame, layouts: Layout | Mapping[str, Layout], dictionary: Iterable[str] | DataFrame,
                 line_col: str = "line", layout_col: str | None = None, mode: str = "compat",
                 tokenizer=None, keep: Sequence[str] | None = None) -> DataFrame:
    """Parse each line by its layout (B3-B12); adds the fields and ``is_reject``.

    A line is rejected when no token is in ``dictionary`` (B12; a list, or a table of
    any size); rejected lines keep their text and null fields instead of being printed and lost.
    ``layouts`` is one layout, or a name -> layout map chosen per row by
    ``layout_col`` (routing, A1).  ``mode='strict'`` realigns a line whose
    second token is not a number (rank missing, quirk 6) and flags lines with
    more than one dictionary token in ``ambiguous``.
    """
    tok = tokenizer or (lambda c: tokenize(c))
    # one projection after the other: what several expressions use is computed once a line
    base = lines.withColumn("__p", tok(F.col(line_col)))
    pc = F.col("__p")
    if mode == "strict":
        shifted = ~F.coalesce(item(pc, 1).rlike(r"^\d+$"), F.lit(False)) & \
            F.coalesce(item(pc, 0).rlike(r"^\d+$"), F.lit(False))
        base = base.withColumn("__p", F.when(shifted, F.concat(F.array(F.lit(None).cast("string")), pc)).otherwise(pc))
    words = _as_literal(dictionary)
    if words is None:
        base = dict_tokens(base, "__p", dictionary, "__i", "__hits")
        hits = F.col("__hits")
    else:
        base = base.withColumn("__w", F.filter(pc, lambda x: x.isin(words)))
        # the first dictionary token's first occurrence is the first dictionary position
        base = base.withColumn("__i", F.array_position(pc, F.get("__w", F.lit(0))).cast("int") - 1)
        hits = F.size("__w")
    i = F.col("__i")
    # the bracket value is computed once per row (several fields test it)
    if isinstance(layouts, Layout):
        base = base.withColumn("__b", _bracket_expr(layouts, pc, i))
        exprs = _layout_exprs(layouts, pc, i, F.col("__b"))
    else:
        bracket = None
        for name, lay in layouts.items():
            cond = F.col(layout_col) == F.lit(name)
            b = _bracket_expr(lay, pc, i)
            bracket = F.when(cond, b) if bracket is None else bracket.when(cond, b)
        base = base.withColumn("__b", bracket)
        per = {name: _layout_exprs(lay, pc, i, F.col("__b")) for name, lay in layouts.items()}
        names = sorted({f for e in per.values() for f in e})
        exprs = {}
        for fname in names:
            out = None
            for lname, e in per.items():
                if fname in e:
                    cond = F.col(layout_col) == F.lit(lname)
                    out = F.when(cond, e[fname]) if out is None else out.when(cond, e[fname])
            exprs[fname] = out
    rejected = i.isNull()
    exprs = {k: F.when(~rejected, v) for k, v in exprs.items()}
    exprs["is_reject"] = rejected
    if mode == "strict":
        exprs["ambiguous"] = F.coalesce(hits, F.lit(0)) > 1
    out = base.withColumns(exprs).drop("__p", "__i", "__b", "__w", "__hits")
    if keep is not None:
        out = out.select(*keep, *exprs.keys())
    return out


def write_parsed(parsed: DataFrame, name: str = "parsed") -> tuple[DataFrame, dict[str, int]]:
    """(table, counts): a parsed frame written in one pass over the text, a folder for each value of ``is_reject``.

    Records and rejects are counted while they are written.
    """
    seen = Observation(name)
    path = scratch_path(parsed.sparkSession, name)
    parsed.observe(seen, F.count_if(~F.col("is_reject")).alias("records"), F.count_if(F.col("is_reject")).alias("rejects")) \
        .write.partitionBy("is_reject").parquet(path)
    return parsed.sparkSession.read.schema(parsed.schema).parquet(path), dict(seen.get)


def split_rejects(parsed: DataFrame, name: str = "parsed") -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(records, rejects, counts) of a parsed frame; both sides read the table that ``write_parsed`` wrote."""
    table, counts = write_parsed(parsed, name)
    return table.filter(~F.col("is_reject")), table.filter("is_reject"), counts


def fill_header(lines: DataFrame, file_col: str, order_cols: Sequence[str],
                fields: Mapping[str, Column], complete_col: str | None = "complete") -> DataFrame:
    """Header values per file by an in-order scan, as aggregates (B2).

    The scan keeps the last match of each field and stops at the first line
    where every field has matched; a file that never completes keeps its last
    matches (quirk 3).  Equivalently: the stop line is the latest of the
    fields' first matches, and each field's value is its last match at or
    before the stop line (or overall, when the file never completes).

    The lines are scanned once, into a table of matches: only lines that match some
    field can change the answer, and the others of a file collapse into one row in
    their task.  The rest works on that table, and no file is gathered into one
    task or one window.  One row per file, also for files with no match.
    """
    vals = {n: f"__v_{n}" for n in fields}
    x = lines.select(F.col(file_col), F.struct(*[F.col(c) for c in order_cols]).alias("__pos"),
                     *[e.alias(vals[n]) for n, e in fields.items()])
    hit = reduce(or_, [F.col(v).isNotNull() for v in vals.values()])
    hits = written(x.withColumn("__pos", F.when(hit, F.col("__pos"))).groupBy(file_col, "__pos")
                   .agg(*[F.max(v).alias(v) for v in vals.values()]), "header-matches")
    firsts = hits.groupBy(file_col).agg(
        *[F.min(F.when(F.col(v).isNotNull(), F.col("__pos"))).alias(f"__f_{n}") for n, v in vals.items()])
    complete = reduce(and_, [F.col(f"__f_{n}").isNotNull() for n in fields])
    stop = firsts.select(F.col(file_col).alias("__file"), complete.alias("__complete"),
                         F.when(complete, _latest([F.col(f"__f_{n}") for n in fields])).alias("__stop"))
    got = hits.join(stop, F.col(file_col).eqNullSafe(F.col("__file"))) \
        .filter(F.col("__stop").isNull() | F.col("__pos").isNull() | (F.col("__pos") <= F.col("__stop"))) \
        .groupBy(file_col).agg(
            F.first("__complete").alias("__complete"),
            *[F.max(F.when(F.col(v).isNotNull(), F.struct(F.col("__pos"), F.col(v).alias("v")))).getField("v").alias(n)
              for n, v in vals.items()])
    cols = [file_col, *fields]
    if complete_col:
        got = got.withColumnRenamed("__complete", complete_col)
        cols.append(complete_col)
    return got.select(*cols)


def _latest(cols: list[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def header_patterns(line: Column | None = None) -> dict[str, Column]:
    """The reference's four header fields as expressions over a stripped line."""
    ln = line if line is not None else F.col("line")
    s = F.regexp_replace(ln, r"(?U)^\s+|\s+$", "")

    def found(pattern: str, may: Column) -> Column:
        return F.when(may & s.rlike(pattern), F.regexp_extract(s, pattern, 0))

    # what a line must hold for a pattern to match at all: most lines hold none of it, and no pattern is run on them.
    # In ASCII text lower case is all there is to letter case; other text goes to the pattern.
    lower = F.lower(ln)
    other = F.octet_length(ln) != F.char_length(ln)
    # event and round match in any letter case; Unicode classes as in Python's re
    return {
        "event_type": found("(?iU)" + EVENT_PATTERN, ln.contains("100")),
        "round": found("(?iU)" + ROUND_PATTERN, lower.contains("round") | lower.contains("final") | other),
        "date": found("(?U)" + DATE_PATTERN, ln.rlike("[A-Z]{3}[^A-Z]{3,4}[A-Z]{3}[^A-Z]{5}")),
        "location": F.when(ln.contains(LOCATION_MARK), s),
    }


def attach_header(records: DataFrame, headers: DataFrame, file_col: str,
                  defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Header columns in front of each record of its file.

    ``defaults`` applies to missing values (strict); the reference's defaults
    never apply, so compat passes none (quirk 1).  One header row per file: the
    planner broadcasts it when small, else shuffles both sides on the file.
    """
    hcols = [c for c in headers.columns if c != file_col]
    joined = records.join(headers, file_col, "left")
    vals = {c: (F.coalesce(F.col(c), F.lit(defaults[c])) if defaults and c in defaults else F.col(c))
            for c in hcols}
    return joined.select(*[vals[c].alias(c) for c in hcols], *records.columns)


def union_files(frames: Mapping[str, DataFrame], tag_col: str = "src") -> DataFrame:
    """Rows of several sources in one frame, tagged (B14); columns by name."""
    out = None
    for tag, df in frames.items():
        t = df.select(F.lit(tag).alias(tag_col), *df.columns)
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out
