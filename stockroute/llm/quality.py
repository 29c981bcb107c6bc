"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised and hashed; per host the distinct document texts that hold
a line are counted (exact copies of a document count once: they are the
deduplicator's business; on request near copies count once, too), lines above
the limits are removed, and documents of which too little is left are rejected.
A second set of rules looks at one document alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .near_dedup import stored
from .words import GAP, WORD

#: A line is removed if more than this share of its host's documents, and at
#: least LEAST_DOCS of them, hold it.
LINE_SHARE = 0.10
LEAST_DOCS = 20
#: On request, a line of SEVERAL or more words is also removed if more than
#: MOST_DOCS documents of its host hold it, or more than this share of all
#: documents and at least CORPUS_DOCS of them.
SEVERAL, MOST_DOCS, CORPUS_SHARE, CORPUS_DOCS = 4, 1000, 0.01, 100
#: A document is rejected if less than this share of its words is left.
LEFT_SHARE = 0.20
#: Keys of a text's set of lines, and least line hashes joined in each: texts that
#: share 0.8 of their lines share a key with probability 0.998, 0.5 with 0.54,
#: 0.3 with 0.09.
KEYS, KEY_LINES, SALTS = 12, 4, 16
SYMBOLS = r"[^#*$%&|<>]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def spaced(line: Column) -> Column:
    """Words joined by one space, lower-cased. Lines are made to words only where
    other blanks or two in a row say so; most have none."""
    other = F.contains(line, F.lit("  "))
    for blank in "\t\n\x0b\x0c\r":
        other = other | F.contains(line, F.lit(blank))
    return F.lower(F.trim(F.when(other, F.regexp_replace(line, GAP, " ")).otherwise(line)))


def words_in(spaced: Column) -> Column:
    """Number of words of a non-empty text with one space between words."""
    return F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1


def digits_as_0(text: Column) -> Column:
    return F.regexp_replace(text, "[0-9]+", "0")


def normalised(line: Column) -> Column:
    """Words joined by one space, lower-cased, digit runs as one 0."""
    return digits_as_0(spaced(line))


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once (a lambda variable)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeat_words(words: Column, width: int = 5) -> Column:
    """Number of words in ``width``-word windows that occur twice or more.

    Window hashes are compared as one sorted array; only a text with a repeat
    sorts its (hash, place) pairs and measures the union of the windows."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = bind(hashes, lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - width),
        lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)])))

    def covered(hash_list):
        pairs = F.array_sort(F.transform(hash_list, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        hits = bind(pairs, lambda p: F.transform(F.filter(
            p, lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"]))
        return bind(F.sort_array(hits), lambda s: F.aggregate(
            F.transform(s, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(s, k + 1) - x, F.lit(width)))),
            F.lit(0), lambda a, x: a + x))

    def count(hash_list):
        return F.when(F.size(F.array_distinct(hash_list)) == F.size(hash_list), 0).otherwise(covered(hash_list))

    return F.when(F.size(words) > width, bind(windows, count)).otherwise(0).cast("long")


def document_rules(text: Column) -> dict[str, Column]:
    """Counts of one text (null counts as empty): n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words."""
    text = F.coalesce(text, F.lit(""))
    words = words_of(text)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
        "n_dup_lines": bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": bind(words, lambda w: repeat_words(w)),
    }


def fingerprint(text: Column) -> list[Column]:
    """Two columns d1, d2: a 128-bit fingerprint of the text."""
    return [F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(1), text).alias("d2")]


def line_keys(lines: Column) -> Column:
    """``KEYS`` hashes of a non-empty array of line hashes, each of ``KEY_LINES``
    least hashes: texts with much the same lines share some of them."""
    least = lambda x, j: F.array_min(F.transform(x, lambda line: F.xxhash64(line, F.lit(j))))
    return bind(lines, lambda x: F.array(*[
        F.xxhash64(F.lit(k), *[least(x, k * KEY_LINES + j) for j in range(KEY_LINES)]) for k in range(KEYS)]))


def line_table(docs: DataFrame, host_col: str, text_col: str, keys: bool = False) -> DataFrame:
    """(host, d1, d2, place, line, words): the lines with a word of each row, as
    hashes of their normalised form; with ``keys`` also keys (:func:`line_keys`)
    at place 0, of the lines as written but for case and spacing (texts that differ
    in digits alone are no near copies)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.transform(F.filter(F.transform(F.split(text, "\n"), spaced), lambda x: x != ""),
                        lambda x: F.struct(F.xxhash64(digits_as_0(x)).alias("line"), words_in(x).alias("words"),
                                           *[F.xxhash64(x).alias("written")] * keys))
    rows = docs.select(F.col(host_col).alias("host"), *fingerprint(text), lines.alias("lines"))
    extra = []
    if keys:
        rows = rows.withColumn("keys", line_keys(F.col("lines.written")))
        extra = [F.when(F.col("place") == 0, F.col("keys")).alias("keys")]
    rows = rows.select("host", "d1", "d2", *["keys"] * keys, F.posexplode("lines").alias("place", "x"))
    return rows.select("host", "d1", "d2", "place", "x.line", "x.words", *extra)


def representatives(lines: DataFrame, least_docs: int, *host: str) -> DataFrame:
    """(*host, d1, d2): the distinct texts (of each host, if given) but those that
    share a key with ``least_docs`` texts or more and haven't its smallest
    fingerprint: one or few of a group of near copies stay. Smaller groups stay
    whole: they are too few to make a line common. A key's texts meet that
    smallest one in SALTS parts."""
    texts = lines.where("place = 0").groupBy(*host, "d1", "d2").agg(F.first("keys").alias("keys"))
    keyed = texts.select(*host, F.struct("d1", "d2").alias("t"), F.explode("keys").alias("key"))
    large = keyed.groupBy(*host, "key").agg(F.min("t").alias("least"), F.count("*").alias("n")).where(F.col("n") >= least_docs)
    large = large.select(*[F.col(h).alias("__h") for h in host], F.col("key").alias("k"), "least",
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    same = (F.col("key") == F.col("k")) & (F.pmod("t.d1", F.lit(SALTS)) == F.col("s"))
    again = [F.col(h).alias("__h") for h in host] + [F.col("t.d1").alias("e1"), F.col("t.d2").alias("e2")]
    own = (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))
    for h in host:
        same, own = same & F.col(h).eqNullSafe(F.col("__h")), own & F.col(h).eqNullSafe(F.col("__h"))
    aside = keyed.join(large, same).where("t <> least").select(*host, "t").distinct().select(*again)
    return texts.select(*host, "d1", "d2").join(aside, own, "left_anti")


def _holders(lines: DataFrame, near_copies: bool, least_docs: int, *host: str) -> tuple[DataFrame, DataFrame]:
    """(*host, d1, d2), the texts that count, and (*host, line, words, d1, d2), the
    lines that they hold, each once."""
    held = lines.select(*host, "line", "words", "d1", "d2").distinct()
    if not near_copies:
        return lines.where("place = 0").select(*host, "d1", "d2").distinct(), held
    texts = stored(representatives(lines, least_docs, *host), "representatives")
    one = texts.select(*[F.col(h).alias("__h") for h in host], F.col("d1").alias("__e1"), F.col("d2").alias("__e2"))
    same = (F.col("d1") == F.col("__e1")) & (F.col("d2") == F.col("__e2"))
    for h in host:
        same = same & F.col(h).eqNullSafe(F.col("__h"))
    return texts, held.join(one, same, "left_semi")


def common_lines(lines: DataFrame, line_share: float, least_docs: int, near_copies: bool = False,
                 most_docs: int | None = None, corpus_share: float | None = None) -> DataFrame:
    """(h, l): hosts and line hashes above the limits, stored."""
    texts, held = _holders(lines, near_copies, least_docs, "host")
    texts = texts.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("docs"))
    counts = (held.groupBy("host", "line").agg(F.count("*").alias("n"), F.max("words").alias("words"))
              .where(F.col("n") >= least_docs))
    over = F.col("n") > line_share * F.col("docs")
    if most_docs is not None:
        over = over | ((F.col("words") >= SEVERAL) & (F.col("n") > most_docs))
    common = counts.join(texts, F.col("host").eqNullSafe(F.col("h"))).where(over).select("h", F.col("line").alias("l"))
    if corpus_share is not None:
        texts, held = _holders(lines.where("place = 0 or words >= %d" % SEVERAL), near_copies, least_docs)
        wide = (held.where(F.col("words") >= SEVERAL).groupBy("line").agg(F.count("*").alias("n"))
                .where(F.col("n") >= CORPUS_DOCS))
        wide = (wide.crossJoin(F.broadcast(texts.agg(F.count("*").alias("docs"))))  # one row
                .where(F.col("n") > corpus_share * F.col("docs")).select(F.col("line").alias("l")))
        everywhere = lines.select(F.col("host").alias("h"), F.col("line").alias("l")).distinct().join(wide, "l", "left_semi")
        common = common.union(everywhere.select("h", "l")).distinct()
    return stored(common, "common-lines")


def quality_rules(docs: DataFrame, line_share: float = LINE_SHARE, least_docs: int = LEAST_DOCS,
                  left_share: float = LEFT_SHARE, text_col: str = "text", host_col: str = "source",
                  near_copies: bool = False, most_docs: int | None = None,
                  corpus_share: float | None = None) -> DataFrame:
    """``docs`` with the counts of :func:`document_rules`, base_failed (fewer than
    10 words, or more than 20 % of them in repeated 5-word windows), common_words
    (words in common lines), common_lines (those lines' hashes, for
    :func:`strip_lines`) and kept. Input columns of these names are replaced; all
    rows stay.

    A line is common if more than ``line_share`` of its host's distinct texts
    and at least ``least_docs`` of them hold it; a document is depleted if its
    other lines have less than ``left_share`` of its words. With ``near_copies``
    only one or few of ``least_docs`` or more texts of a host with much the same
    lines are counted, as holders and as texts (:func:`representatives`), so that a group of near
    copies does not make its own lines common; the query's SQL counts all. With
    ``most_docs`` and ``corpus_share`` a line of ``SEVERAL`` words is common too
    if more texts of its host hold it, or more than that share of all texts (and
    at least ``CORPUS_DOCS``).

    Null and empty texts have zero counts and fail. A null host is a host of its
    own. Repeated rows count as one document and get the same result. Tables may
    be empty.

    Hot hosts, lines and copies: rows are counted after a partial aggregation in
    their own map task, first to distinct (host, line, text), then to (host,
    line). A host has at most 1 / line_share common lines for each line of an
    average text, the corpus 1 / corpus_share; they are stored, so the join back
    picks its strategy from their real size.
    """
    lines = stored(line_table(docs, host_col, text_col, near_copies), "lines")
    common = common_lines(lines, line_share, least_docs, near_copies, most_docs, corpus_share)
    lost = (lines.join(common, F.col("host").eqNullSafe(F.col("h")) & (F.col("line") == F.col("l")))
            .select("host", "d1", "d2", "place", "line", "words").distinct()  # copies of a text collapse
            .groupBy("host", "d1", "d2").agg(F.sum("words").alias("common_words"), F.collect_set("line").alias("common_lines"))
            .select(F.col("host").alias("__h"), F.col("d1").alias("__e1"), F.col("d2").alias("__e2"),
                    "common_words", "common_lines"))
    d1, d2 = fingerprint(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.drop("common_words", "common_lines").withColumns(
        document_rules(F.col(text_col)) | {"__d1": d1, "__d2": d2})
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("common_words")
    return (rows.join(lost, F.col(host_col).eqNullSafe(F.col("__h")) & (F.col("__d1") == F.col("__e1"))
                      & (F.col("__d2") == F.col("__e2")), "left")
            .withColumn("common_words", F.coalesce("common_words", F.lit(0)))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (left >= left_share * F.col("n_words")))
            .drop("__d1", "__d2", "__h", "__e1", "__e2"))


def strip_lines(text: Column, hashes: Column) -> Column:
    """The text without the lines whose normalised hash is listed (null: none)."""
    kept = F.filter(F.split(text, "\n"), lambda x: ~(x.rlike(WORD) & F.array_contains(hashes, F.xxhash64(normalised(x)))))
    return F.when(hashes.isNull(), text).otherwise(F.array_join(kept, "\n"))
