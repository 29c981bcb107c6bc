"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong candidates (assignments to secret names, access key ids, long hex runs)
are reported by themselves. Weak ones (login names, random-looking strings, urls
and hosts with a port) are parts of a credential: they are reported only if a
complementary part starts within ``SCOPE`` characters of them, found by an
interval join over cells of that width.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .near_dedup import stored
from .quality import bind, fingerprint

#: Parts of one credential start at most so many characters apart.
SCOPE = 300

_ANY_CASE = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)

#: Strong kinds in their order: pattern, the group whose length counts, its least.
NAMES = "(" + "|".join(_ANY_CASE(w) for w in ("password", "passwd", "secret", "token")) + "|" + _ANY_CASE("api") + "_?" + _ANY_CASE("key") + ")"
STRONG = {
    "assign": (NAMES + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": ("AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": ("[0-9a-f]{16,}", 0, 16),
}
#: Weak kinds: pattern and the part of a credential that it may be.
WEAK = {
    "login": ("(?:" + "|".join(_ANY_CASE(w) for w in ("client_id", "username", "access_key_id", "account", "login", "user"))
              + r""")["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""", "id"),
    "random": ("[A-Za-z0-9+/_=-]{20,}", "secret"),
    "endpoint": (r"(?:[a-z]{2,12}://[A-Za-z0-9.-]{3,}(?::[0-9]{1,5})?|[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,5}:[0-9]{2,5})", "endpoint"),
}
#: What the text of a weak match must hold besides.
MUST = {"random": ("[0-9]", "[A-Z]", "[a-z]")}
PART = {"assign": "secret", "access": "id", "hex": "secret"} | {k: part for k, (_, part) in WEAK.items()}
ORDER = {kind: i for i, kind in enumerate([*STRONG, *WEAK])}
SPAN = "struct<start:int,place:int,end:int,kind:string>"


#: Items gathered at once: an aggregate copies its state at every step, so the
#: spans in it must stay few whatever a text holds.
CHUNK = 128
_NONE = f"array<{SPAN}>"


def gathered(items: Column, zero: Column, weight, combine, emit) -> Column:
    """The spans that ``emit(state, item)`` gives (null: none), the state before an
    item being all earlier ``weight(item)`` combined. Items are taken in chunks, each
    from the combined weights of the chunks before it."""
    over = lambda values, use: F.aggregate(values, zero, lambda a, x: combine(a, use(x)))
    chunks = F.when(F.size(items) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")), lambda c: F.slice(items, c * CHUNK + 1, CHUNK)))

    def merge(a, x):
        span = emit(a["state"], x)
        return F.struct(combine(a["state"], weight(x)).alias("state"),
                        F.when(span.isNull(), a["new"]).otherwise(F.concat(a["new"], F.array(span))).alias("new"))

    def run(parts, totals):
        before = lambda i: F.aggregate(F.slice(totals, F.lit(1), i), zero, combine)
        begin = lambda i: F.struct(before(i).alias("state"), F.array().cast(_NONE).alias("new"))
        return F.flatten(F.transform(parts, lambda part, i: F.aggregate(part, begin(i), merge, lambda a: a["new"])))

    found = bind(chunks, lambda parts: bind(F.transform(parts, lambda part: over(part, weight)), lambda totals: run(parts, totals)))
    return F.coalesce(found, F.array().cast(_NONE))


def find(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Spans (code points, end exclusive) of the leftmost non-overlapping matches
    whose ``group`` has at least ``least`` characters and that hold what ``MUST``
    says of the kind. Starts come from the
    lengths of the pieces between matches, which the pattern splits the text to."""
    def holds(x):
        return functools.reduce(lambda a, b: a & b, [x.rlike(p) for p in MUST.get(kind, ())], F.lit(True))

    hits = F.arrays_zip(F.transform(F.split(text, pattern), lambda x: F.length(x)).alias("gap"),
                        F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), lambda x: F.length(x)).alias("size"),
                        F.transform(F.regexp_extract_all(text, F.lit(pattern), group), lambda x: F.length(x)).alias("part"),
                        F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), holds).alias("holds"))

    def emit(at, x):
        start = at + x["gap"]
        span = F.struct(start.alias("start"), F.lit(ORDER[kind]).alias("place"), (start + x["size"]).alias("end"), F.lit(kind).alias("kind"))
        return F.when(x["size"].isNotNull() & (x["part"] >= least) & x["holds"], span)

    spans = bind(hits, lambda h: gathered(h, F.lit(0), lambda x: x["gap"] + F.coalesce(x["size"], F.lit(0)), lambda a, b: a + b, emit))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_NONE))


def free_of(weak: Column, strong: Column) -> Column:
    """The weak spans that overlap no strong one, by two passes over both in the
    order of their starts: forwards none before may reach into a span, backwards none
    after may begin in it."""
    is_weak = lambda x: x["place"] >= len(STRONG)
    last = F.lit((1 << 31) - 1)

    def forwards(spans):
        return gathered(spans, F.lit(0), lambda x: F.when(is_weak(x), 0).otherwise(x["end"]), lambda a, b: F.greatest(a, b),
                        lambda reach, x: F.when(~is_weak(x) | (x["start"] >= reach), x))

    def backwards(spans):
        return gathered(spans, last, lambda x: F.when(is_weak(x), last).otherwise(x["start"]), lambda a, b: F.least(a, b),
                        lambda begins, x: F.when(is_weak(x) & (x["end"] <= begins), x))

    # Strong kinds come first among equal starts (by place).
    both = bind(F.sort_array(F.concat(strong, weak)), forwards)
    return F.when((F.size(weak) == 0) | (F.size(strong) == 0), weak).otherwise(bind(F.reverse(both), backwards))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` in the order of starts, then kinds, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def link_parts(parts: DataFrame, scope: int) -> DataFrame:
    """The weak rows of ``parts`` (d1, d2, start, place, end, kind, weak, part)
    with their complements in reach: an id needs a secret, a secret needs an id or
    an endpoint, an endpoint needs both.

    Interval join: a part of a text is filed under the cell ``start / scope``; a
    cell keeps the first and last start for each kind of part, so it is one row
    whatever it holds; a weak part meets its own and the two adjacent cells.
    """
    cell = F.floor(F.col("start") / scope)
    filed = parts.groupBy("d1", "d2", cell.alias("cell"), F.col("part").alias("near")).agg(
        F.min("start").alias("first"), F.max("start").alias("last"))
    weak = parts.where("weak").distinct().select("*", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    met = weak.join(filed, ["d1", "d2", "cell"]).where(
        (F.col("first") - F.col("start") <= scope) & (F.col("start") - F.col("last") <= scope))
    sees = lambda part: F.max(F.col("near") == part).alias("sees_" + part)
    seen = met.groupBy("d1", "d2", "start", "place", "end", "kind", "part").agg(sees("id"), sees("secret"), sees("endpoint"))
    return seen.where("(part = 'id' and sees_secret) or (part = 'secret' and (sees_id or sees_endpoint))"
                      " or (part = 'endpoint' and sees_id and sees_secret)")


def find_secrets(docs: DataFrame, scope: int = SCOPE, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row, base (strong spans) and spans (with the
    linked weak ones): arrays of (start, place, end, kind), sorted.

    Strong kinds may overlap each other; weak spans that overlap a strong one are
    not reported again. Null and empty texts have no spans. Spans depend on the
    text alone, so repeated rows agree and copies of a text are linked once. An
    empty table gives an empty result; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    strong = F.sort_array(F.concat(*[find(text, k, *v) for k, v in STRONG.items()]))
    weak = F.concat(*[find(text, k, p) for k, (p, _) in WEAK.items()])
    free = free_of(F.col("weak"), F.col("base"))
    rows = (docs.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(keep)], *fingerprint(text),
                        strong.alias("base"), weak.alias("weak"))
            .withColumn("weak", free))
    rows = stored(rows, "candidates")
    both = F.concat(F.transform("base", lambda x: F.struct(x.alias("x"), F.lit(False).alias("weak"))),
                    F.transform("weak", lambda x: F.struct(x.alias("x"), F.lit(True).alias("weak"))))
    part = F.element_at(F.create_map(*[F.lit(x) for pair in PART.items() for x in pair]), F.col("p.x.kind"))
    parts = (rows.where(F.size("weak") > 0).select("d1", "d2", F.explode(both).alias("p"))
             .select("d1", "d2", "p.x.start", "p.x.place", "p.x.end", "p.x.kind", "p.weak", part.alias("part")).distinct())
    linked = (link_parts(parts, scope).groupBy("d1", "d2")
              .agg(F.collect_list(F.struct("start", "place", "end", "kind")).alias("linked")))
    spans = F.sort_array(F.concat("base", F.coalesce("linked", F.array().cast(f"array<{SPAN}>"))))
    named = [F.col(f"__{i}").alias(c) for i, c in enumerate(keep)]
    # Rows without a weak part have nothing to look up and are not shuffled.
    alone = rows.where(F.size("weak") == 0).select(*named, "base", F.col("base").alias("spans"))
    met = rows.where(F.size("weak") > 0).join(linked, ["d1", "d2"], "left")
    return alone.unionByName(met.select(*named, "base", spans.alias("spans")))
