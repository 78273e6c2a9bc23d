"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Five measures of a text (per mille: symbols, capitals and exclamation marks in
its word characters, repeated lines, words in repeated 3-word windows) each
have a cutoff per stratum (language). The cutoffs of a stratum are chosen
together on labelled documents that the base rules keep, so that the rate of
good ones that any of them rejects is at most ``RISK``. One in ``PLANNING``
labels of a stratum plans: it puts the (measure, cutoff) pairs that catch a bad
document in an order, those that lose it the fewest good ones first. The other
labels test: step by step along that fixed order, the pairs taken so far are
tested jointly by the exact binomial tail P(Bin(good, RISK) <= rejected good)
<= level, and the sequence stops at the first step that fails (fixed-sequence
testing: no correction is owed within it); the level is ``DELTA`` divided by the
number of strata (Bonferroni). By the union bound, with probability 1 - DELTA
no stratum loses more than ``RISK`` of its good documents; some 144 good labels
without a loss are enough with four strata. Of the steps that passed, the one of
least cost is taken: bad documents missed plus ``WORTH`` times the good ones
lost, as rates. A stratum with too few labels gets no cutoff (a row of
``cutoffs`` without any), and then only the base rules reject.

Base rules: fewer than 50 words, or more than half of the words in repeated
windows.

Defined results: null text is empty (fails the base rules); a null language is
a stratum of its own; labels without a doc_id or quality, or that contradict
each other for a document, are not used; repeated rows get a row each; no rows
give no rows. Columns of any other name pass through ``keep`` as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsdesk.llm.common import settled

RISK, DELTA, WORTH = 0.03, 0.05, 10.0
PLANNING = 4  # one label in so many plans, the others test
STEP, BINS = 25, 40  # cutoffs: multiples of 25 per mille up to 1000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = ["m_symbols", "m_capitals", "m_marks", "m_dup_lines", "m_repeats"]
#: A stratum table of up to so many rows is broadcast, a larger one is joined.
BROADCAST_ROWS = 100_000


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def measured(docs: DataFrame) -> DataFrame:
    """The rows with COUNTS (long), base_failed and MEASURES (int).

    For the repeated windows, their hashes are sorted with their places; equal
    neighbours mark places, and each marked place adds the words of its window
    that the one before did not cover."""
    keep = [c for c in docs.columns if c not in (*COUNTS, *MEASURES, "base_failed")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(*keep, text.alias("_text"))
    d = d.withColumn("_words", F.filter(F.split("_text", r"[ \t-\r]+"), lambda w: w != ""))
    d = d.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    d = d.withColumn("_signs", F.regexp_replace("_text", r"[^#*$%&|<>A-Z!?]+", ""))
    n = F.size("_words")
    d = d.withColumn("_hash", F.slice(
        F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))),
        F.lit(1), F.greatest(n - 2, F.lit(0))))
    # most texts repeat no window, and need no sort
    some = F.size(F.array_distinct("_hash")) < F.size("_hash")
    d = d.withColumn("_placed", F.when(some, F.sort_array(F.transform("_hash", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    hash_at = lambda k: F.get("_placed", k)["h"]
    d = d.withColumn("_marked", F.sort_array(F.filter(
        F.transform("_placed", lambda x, k: F.when((x["h"] == hash_at(k - 1)) | (x["h"] == hash_at(k + 1)), x["i"])),
        lambda i: i.isNotNull())))
    covered = F.aggregate(
        "_marked", F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(3), i - a["at"])).alias("n")), lambda a: a["n"])
    signs = F.char_length("_signs")
    d = d.withColumns({
        "n_words": n.cast("long"), "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (signs - _without(F.col("_signs"), SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "_capitals": signs - _without(F.col("_signs"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "_marks": signs - _without(F.col("_signs"), "!?"), "_n_lines": F.size("_lines")})
    rate = lambda a, b: F.when(b > 0, F.floor(F.col(a) * 1000 / b)).otherwise(0).cast("int")
    d = d.withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "m_symbols": rate("n_symbols", F.col("word_chars")), "m_capitals": rate("_capitals", F.col("word_chars")),
        "m_marks": rate("_marks", F.col("word_chars")), "m_dup_lines": rate("n_dup_lines", F.col("_n_lines")),
        "m_repeats": rate("n_repeat_words", F.col("n_words"))})
    return d.select(*keep, *COUNTS, "base_failed", *MEASURES)


def _log_factorial(n: Column) -> Column:
    """ln n!: Stirling's series from 20 on, the factorial below."""
    x = F.greatest(n, F.lit(1)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5)))
    return F.when(n < 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def _tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) for k < n p. Terms fall by a constant factor at least
    going down from k; the sum ends where the rest is under 1e-12 of it."""
    top = (_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p))
    odds = (1 - p) / p
    fall = k * odds / (n - k + 1)  # the first and largest ratio of neighbours
    steps = F.least(k, F.ceil(-28 / F.log(F.least(F.greatest(fall, F.lit(1e-9)), F.lit(1 - 1e-9)))).cast("long"))
    total = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(0).cast("long"), steps - 1)).otherwise(F.array().cast("array<bigint>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda a, j: F.struct((a["term"] * (k - j) / (n - k + j + 1) * odds).alias("term"),
                              (a["sum"] + a["term"] * (k - j) / (n - k + j + 1) * odds).alias("sum")),
        lambda a: a["sum"])
    return F.exp(top) * total


def cutoffs(rows: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Per stratum with labels a row: n_good (tested), and the smallest per
    mille that each measure rejects at (null: it rejects nothing). ``rows`` has
    doc_id, the stratum, MEASURES and base_failed."""
    sure = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id")
            .agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high")
            .select("doc_id", (F.col("low") > 0).alias("good")))
    values = F.array(*(F.least(F.floor(F.col(m) / STEP), F.lit(BINS)).cast("int") for m in MEASURES))
    known = rows.where(~F.col("base_failed")).select(
        "doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("\0")).alias("_s"), values.alias("bins")).join(sure, "doc_id")
    known = known.withColumn("plans", F.pmod(F.xxhash64("doc_id"), F.lit(PLANNING)) == 0)
    # at most strata x measures x (BINS + 1) rows from here on
    counted = (known.select("_s", "plans", "good", F.posexplode("bins").alias("m", "bin")).groupBy("_s", "m", "bin")
               .agg(*(F.count_if(F.col("plans") & (F.col("good") == g)).alias(n) for g, n in ((True, "lost"), (False, "caught")))))
    every = (counted.select("_s").distinct().select("_s", F.explode(F.sequence(F.lit(0), F.lit(len(MEASURES) - 1))).alias("m"))
             .select("_s", "m", F.explode(F.sequence(F.lit(1), F.lit(BINS))).alias("bin")))
    above = Window.partitionBy("_s", "m").orderBy(F.desc("bin"))
    planned = every.join(counted, ["_s", "m", "bin"], "left").withColumns({
        n: F.sum(F.coalesce(n, F.lit(0))).over(above) for n in ("lost", "caught")})
    # the fixed sequence: cutoffs that cost the planning part least come first
    path = planned.where("caught > 0").withColumn("step", F.row_number().over(
        Window.partitionBy("_s").orderBy("lost", F.desc("caught"), F.desc("bin"), "m")))
    steps = path.groupBy("_s").agg(F.sort_array(F.collect_list(F.struct("step", "m", "bin"))).alias("path"))  # at most 200
    first = F.array_min(F.transform(F.filter("path", lambda x: F.get("bins", x["m"]) >= x["bin"]), lambda x: x["step"]))
    tested = (known.where(~F.col("plans")).join(steps, "_s", "left").withColumn("step", first)
              .groupBy("_s", "step").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    totals = tested.groupBy("_s").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    strata = totals.agg(F.count("*").alias("n_strata"))
    upto = Window.partitionBy("_s").orderBy("step")
    walk = (path.select("_s", "step").join(tested, ["_s", "step"], "left").join(totals, "_s").crossJoin(F.broadcast(strata))  # one row
            .withColumns({"k": F.sum(F.coalesce("good", F.lit(0))).over(upto), "c": F.sum(F.coalesce("bad", F.lit(0))).over(upto)}))
    k, n = F.col("k"), F.col("n_good")
    sure_ = F.when(k < n * risk, _tail(k, n, risk) <= delta / F.col("n_strata")).otherwise(False)
    passed = walk.withColumn("passed", F.min(sure_.cast("int")).over(upto) == 1).where("passed and c > 0")
    cost = 1 - F.col("c") / F.col("n_bad") + WORTH * k / n
    best = passed.groupBy("_s").agg(F.min(F.struct(cost.alias("cost"), "step")).alias("best")).select("_s", F.col("best.step").alias("last"))
    cuts = path.join(best, "_s").where("step <= last").groupBy("_s").agg(
        *(F.min(F.when(F.col("m") == i, F.col("bin") * STEP)).alias(f"cut_{m}") for i, m in enumerate(MEASURES)))
    return totals.select("_s", "n_good").join(cuts, "_s", "left")


def judged(rows: DataFrame, cuts: DataFrame, stratum: str = "lang") -> DataFrame:
    """The measured rows with ``kept``."""
    if cuts.count() <= BROADCAST_ROWS:
        cuts = F.broadcast(cuts)
    out = rows.withColumn("_s", F.coalesce(F.col(stratum).cast("string"), F.lit("\0"))).join(cuts, "_s", "left")
    over = [F.coalesce(F.col(m) >= F.col(f"cut_{m}"), F.lit(False)) for m in MEASURES]
    rejected = F.col("base_failed")
    for x in over:
        rejected = rejected | x
    return out.withColumn("kept", ~rejected).select(*rows.columns, "kept")


def decide(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Per document its counts, measures, base_failed and kept; ``docs`` needs
    doc_id, text and the stratum."""
    rows = settled(measured(docs.select("doc_id", "text", stratum)).drop("text"), "quality")
    return judged(rows, settled(cutoffs(rows, labels, stratum), "cutoffs"), stratum)


def keep(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of the kept documents, with the columns of ``docs``: they are
    carried in one struct, so that no name meets one of the measures'."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = settled(measured(docs.select(whole, "doc_id", "text", stratum)).drop("text"), "quality")
    cuts = settled(cutoffs(rows, labels, stratum), "cutoffs")
    return judged(rows, cuts, stratum).where("kept").select("row.*")
