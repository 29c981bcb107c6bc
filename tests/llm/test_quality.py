import random
import re
from collections import Counter

from pyspark.sql import functions as F

from stockroute.llm import quality, queries, stages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    cover = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)


def normal(line):
    return re.sub("[0-9]+", "0", " ".join(WORD.findall(line)).lower())


def brute(rows):
    """(counts, failed, kept) of every row by whole-corpus dictionaries."""
    holders, texts = {}, {}
    for _, text, host in rows:
        lines = [normal(x) for x in (text or "").split("\n") if WORD.search(x)]
        if lines:
            texts.setdefault(host, set()).add(text)
        for line in lines:
            holders.setdefault((host, line), set()).add(text)
    common = {k for k, v in holders.items() if len(v) >= quality.LEAST_DOCS and len(v) > quality.LINE_SHARE * len(texts[k[0]])}
    out = []
    for _, text, host in rows:
        c = counts(text)
        lost = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if WORD.search(x) and (host, normal(x)) in common)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        out.append((*c, failed, not failed and c[0] - lost >= quality.LEFT_SHARE * c[0]))
    return out, common


def corpus():
    rng = random.Random(7)
    word = lambda: rng.choice(["alpha", "Beta", "é", "𝔘x", "#tag", "a&b", "12"]) + str(rng.randrange(5000))
    line = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for i in range(240):
        host = "big" if i % 3 else rng.choice(["a", None])
        parts = [line(rng.randint(1, 15)) for _ in range(rng.randint(1, 6))]
        if i % 4 == 0:
            parts.insert(0, f"Subscribe now to  our newsletter, issue {i} of the year and more words here")
        if i % 10 == 1:
            parts = ["Subscribe now to our newsletter, issue 7 of the YEAR and more words here", "one two"]
        if i % 9 == 0:
            parts += parts[:2]
        rows.append((i, "\n".join(parts), host))
    rows += [(300 + i, None, "big") for i in range(2)] + [(310, "", "a"), (311, " \n\t", "a"), (312, "x y z", None)]
    rows += [(320, "same " * 40, "a"), (321, "a b c d e " * 2, "a"), (322, "a b c d e f a b c d e", "a"), (323, "w " * 30000 + "end", "a")]
    copied = "\n".join(" ".join(f"{w}{k}" for k in "qrstuv") for w in "abcdefgh")
    rows += [(400 + i, copied, "big") for i in range(60)] + [(5, rows[5][1], rows[5][2]), (None, rows[6][1], rows[6][2])]
    return rows


def test_equals_brute_force(spark, frame, saved):
    rows = corpus()
    want, common = brute(rows)
    assert common and any(not w[-1] and not w[-2] for w in want)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = queries.op7_quality_rules(spark, saved(documents=frame(rows))).collect()
    assert sorted(((str(r.doc_id), *(r[c] for c in cols)) for r in got)) == sorted((str(i), *w) for (i, _, _), w in zip(rows, want))


def test_exact_copies_do_not_make_their_lines_common(spark, frame):
    got = [r.kept for r in quality.quality_rules(frame(corpus())).where("doc_id between 400 and 459").collect()]
    assert got == [True] * 60


def test_common_lines_are_stripped(spark, frame):
    rows = corpus()
    _, common = brute(rows)
    hosts = {(str(i), t): h for i, t, h in rows}
    found = quality.quality_rules(frame(rows))
    for r in found.withColumn("left", quality.strip_lines(found.text, found.common_lines)).where("text is not null").collect():
        host = hosts[str(r.doc_id), r.text]
        want = [x for x in r.text.split("\n") if not (WORD.search(x) and (host, normal(x)) in common)]
        assert r.left == "\n".join(want)


def test_plan_has_no_python_and_empty_table(spark, frame):
    df = quality.quality_rules(frame([(1, "x")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert quality.quality_rules(frame([(1, "x")]).limit(0)).count() == 0


def near_copy_corpus():
    """200 near copies (a word changed or added in one of ten lines) and 300 other
    texts of one source, half of them with a footer of three lines."""
    rng = random.Random(11)
    line = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    body, rows = [line(8) for _ in range(10)], []
    for i in range(200):
        copy, k = list(body), rng.randrange(10)
        copy[k] = copy[k] + f" added{'x' * i}" if i % 2 else copy[k].replace(copy[k].split()[3], f"changed{'x' * i}")
        rows.append((i, "\n".join(copy), "s"))
    footer = ["Subscribe to our newsletter now", "All rights are reserved by us", "Read more of this on our page"]
    for i in range(300):
        rows.append((1000 + i, "\n".join([line(8) for _ in range(12)] + footer * (i % 2)), "s"))
    return rows, footer


def test_near_copies_do_not_make_their_lines_common(spark, frame):
    rows, footer = near_copy_corpus()
    got = {r.doc_id: r.text for r in stages.quality(spark, frame(rows).withColumn("n_chars", quality.F.length("text")), "").collect()}
    assert sorted(got) == [i for i, _, _ in rows]
    for i, text, _ in rows:  # near copies stay whole; a footer goes, its inner lines too
        assert got[i].split("\n") == [x for x in text.split("\n") if x not in footer]


def test_representatives(spark, frame):
    rows, _ = near_copy_corpus()
    lines = quality.line_table(frame(rows + rows[:50]), "source", "text", keys=True)
    ids = frame(rows).select("doc_id", *quality.fingerprint(quality.F.col("text")))
    found = [r.doc_id for r in quality.representatives(lines, quality.LEAST_DOCS, "host").join(ids, ["d1", "d2"]).collect()]
    assert 1 <= sum(i < 1000 for i in found) <= 5 and sum(i >= 1000 for i in found) >= 280


def test_lines_over_absolute_and_corpus_limits(spark, frame, monkeypatch):
    rng = random.Random(13)
    line = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    spread, hot, short = "Share this page with all your friends", "Log in to leave a comment here", "Read more"
    rows = []
    for i in range(1000):
        host = "big" if i < 600 else f"s{i % 20}"
        extra = [short] * (i % 2 == 0)
        extra += [hot] * (host == "big" and i % 15 == 0)  # 40 of 600 of one host, 4 % of all
        extra += [spread] * (host != "big" and i % 2 == 0)  # at most 20 of a host
        rows.append((i, "\n".join([line(8) for _ in range(6)] + extra + [line(8)]), host))

    def left(**limits):
        found = quality.quality_rules(frame(rows), line_share=1.0, near_copies=True, **limits)
        text = quality.strip_lines(found.text, found.common_lines)
        return [x for r in found.select(text.alias("text")).collect() for x in r.text.split("\n")]

    count = Counter(left())
    assert (count[hot], count[spread], count[short]) == (40, 200, 500)
    count = Counter(left(most_docs=30))
    assert (count[hot], count[spread], count[short]) == (0, 200, 500)
    count = Counter(left(corpus_share=0.05))
    assert (count[hot], count[spread], count[short]) == (40, 0, 500)
    count = Counter(left(most_docs=quality.MOST_DOCS, corpus_share=quality.CORPUS_SHARE))
    assert (count[hot], count[spread], count[short]) == (40, 0, 500)


def test_query_removes_common_lines_and_keeps_near_copies(spark, frame, saved):
    rows, footer = near_copy_corpus()
    menu = [(2000 + i, "\n".join([*footer, f"Nr {i}"]), "s") for i in range(30)]  # little but common lines
    got = {r.doc_id: r for r in queries.op7_quality_rules(spark, saved(documents=frame(rows + menu))).collect()}
    size = sum(len(x.split()) for x in footer)
    for i, text, _ in rows:
        assert got[i].kept and got[i].n_common_words == (size if footer[0] in text else 0)
    assert not any(got[i].kept or got[i].base_failed for i, _, _ in menu)


def test_lines_are_normalised_by_their_words(spark):
    texts = ["A  B\tc", " a b  C ", "a b c\r", "x\x0by 12 345", "é É 7", "one", " \t", "", "a\x1fb", "a  b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    words = [WORD.findall(t) for t in texts]
    got = df.select(quality.normalised(F.col("t")).alias("n"), quality.words_in(quality.spaced(F.col("t"))).alias("k")).collect()
    assert [r.n for r in got] == [re.sub("[0-9]+", "0", " ".join(w).lower()) for w in words]
    assert [r.k for r in got if r.n] == [len(w) for w in words if w]
