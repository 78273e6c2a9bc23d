"""Chat formatting by quotation linking.

Lines that begin with ``>`` are quotes, one level for each sign. Runs of lines
of one level are a passage, and so are its paragraphs between blank quoted lines;
its text, in lower case with single spaces, is hashed, as is each line. The same hashes of the messages' own lines,
paragraphs and whole texts are the originals; a hash of a quote belongs to the
latest message before it in the conversation that has it as its own. A message
replies to the message that most of its shallowest linked quotes belong to (a
tie: the later one). Each message comes out without quotes and without the
"... wrote:" line before them, with its parent, the root of its thread and its
depth; ordered by (root, depth, turn) a message follows what it replies to, and
messages without links keep the order of their turns.

The window that finds originals holds one hash of one conversation at a time,
and only hashes that some quote has; roots are found by doubling steps over
tables written in between, so a long chain of replies takes a few rounds.

Defined results: null text is empty; a message whose quotes match nothing has
no parent; rows that repeat (conversation, turn) are one message with several
rows; rows without conversation or turn have no parent; no rows give no rows.
Columns other than the two keys, role and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsdesk.llm.common import settled

KEYS = ["conv_id", "turn"]


def _plain(x) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), r"\s+", " "))


def _parsed(messages: DataFrame) -> DataFrame:
    """The rows with lines: array of (level, text)."""
    mark = r"^\s*((?:>\s?)+)"
    line = lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, mark, 1), r"\s", "")).alias("level"),
        F.regexp_replace(x, mark, "").alias("text"))
    return messages.withColumn("lines", F.transform(F.split("text", "\r?\n"), line))


def _own_text(lines) -> Column:
    wrote = lambda x, i: (x["text"].rlike(r"wrote:\s*$") & (F.get(lines, i + 1)["level"] > 0))
    kept = F.filter(lines, lambda x, i: (x["level"] == 0) & ~F.coalesce(wrote(x, i), F.lit(False)))
    return F.trim(F.array_join(F.transform(kept, lambda x: x["text"]), "\n"))


def linked(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (own), n_quoted (lines), parent_turn,
    root_turn, depth: per row."""
    rows = messages.select(*KEYS, "role", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parsed = settled(_parsed(rows).withColumn("n_quoted", F.size(F.filter("lines", lambda x: x["level"] > 0)))
                     .withColumn("own", _own_text(F.col("lines"))).drop("text"), "messages")
    keyed = parsed.where("conv_id is not null and turn is not null")

    # quotes: runs of one level in a row, their paragraphs and their lines
    # the row's number comes before the explode: beside it each line would get its own
    each = (keyed.where("n_quoted > 0").select(*KEYS, F.monotonically_increasing_id().alias("row"), "lines")
            .select(*KEYS, "row", F.posexplode("lines").alias("at", "line"))
            .select(*KEYS, "row", "at", "line.level", _plain(F.col("line.text")).alias("text")))
    of = Window.partitionBy("row").orderBy("at")
    each = each.withColumn("run", F.sum((F.col("level") != F.lag("level", 1, -1).over(of)).cast("int")).over(of))
    each = each.withColumn("para", F.sum((F.col("text") == "").cast("int")).over(of))
    parts = each.where("level > 0 and text <> ''").groupBy(*KEYS, "row", "run", "level", "para").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), " ").alias("text"),
        F.count("*").alias("weight"))
    runs = parts.groupBy(*KEYS, "row", "run", "level").agg(
        F.array_sort(F.collect_list(F.struct("para", "text", "weight"))).alias("parts"), F.sum("weight").alias("weight"))
    whole = F.array(F.struct(F.array_join(F.transform("parts", lambda x: x["text"]), " ").alias("text"), F.col("weight").alias("weight")))
    inner = F.transform("parts", lambda x: F.struct(x["text"].alias("text"), x["weight"].alias("weight")))
    passages = runs.select(*KEYS, "level", F.explode(F.when(F.size("parts") > 1, F.concat(whole, inner)).otherwise(whole)).alias("x"))
    quotes = settled(passages.select(*KEYS, "level", "x.text", "x.weight").unionByName(
        each.where("level > 0 and text <> ''").select(*KEYS, "level", "text", F.lit(1).cast("long").alias("weight")))
        .select(*KEYS, "level", F.xxhash64("text").alias("hash"), "weight"), "quotes")

    # originals: own lines, paragraphs and whole texts that some quote may be
    pieces = F.flatten(F.array(F.split("own", "\n"), F.split("own", r"\n\s*\n"), F.array("own")))
    own = (keyed.select(*KEYS, F.explode(F.array_distinct(pieces)).alias("piece"))
           .select(*KEYS, F.xxhash64(_plain(F.col("piece"))).alias("hash")).distinct()
           .join(quotes.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi"))
    events = own.select(*KEYS, "hash", F.col("turn").alias("original"), F.lit(None).cast("int").alias("level"), F.lit(0).cast("long").alias("weight")
                        ).unionByName(quotes.select(*KEYS, "hash", F.lit(None).cast(own.schema["turn"].dataType).alias("original"), "level", "weight"))
    before = Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = events.withColumn("original", F.max("original").over(before)).where("level is not null and original is not null")
    voted = found.groupBy(*KEYS, "level", "original").agg(F.sum("weight").alias("votes"))
    parents = voted.groupBy(*KEYS).agg(F.min(F.struct("level", (-F.col("votes")).alias("v"), (-F.col("original")).alias("o"))).alias("best")).select(
        *KEYS, (-F.col("best.o")).alias("parent_turn"))
    parents = settled(parents, "parents")
    out = parsed.join(parents, KEYS, "left").join(_rooted(parents), KEYS, "left")
    return out.select(*KEYS, "role", F.col("own").alias("text"), "n_quoted", "parent_turn",
                      F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))


def _rooted(parents: DataFrame) -> DataFrame:
    """root_turn and depth of the messages that have a parent."""
    up = parents.select(*KEYS, F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth"))
    while True:
        above = up.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("higher"), F.col("depth").alias("more"))
        new = settled(up.join(above, ["conv_id", "root_turn"], "left").select(
            *KEYS, F.coalesce("higher", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("higher").isNotNull().alias("moved")), "roots")
        up = new.select(*KEYS, "root_turn", "depth")
        if not new.where("moved").limit(1).count():
            return up


def ordered(rows: DataFrame) -> DataFrame:
    """The linked rows in reply order, conversation after conversation."""
    by = ["conv_id", "root_turn", "depth", "turn"]
    return rows.repartitionByRange(*by).sortWithinPartitions(*by)
