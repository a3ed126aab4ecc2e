"""Spelling variants: words one edit apart, found by walking a trie with a frontier of states, level by level.

The vocabulary is a trie as a distributed edge table, once over the words and once over the reversed words: two
words one edit apart agree in at least the first half of one of them.  Chains without a branch are one
edge, so a level is a branching point, and a very long word costs as few levels as a short one.

A state is (word, position, node, edits), the position being what is left of the word.  Before the edit a word walks
along its own path, so its first frontier is its own branching points in the later half.  There it leaves its path by an
edge that begins with another code point, taking its one edit: its own code point is passed over, or replaced by a larger
one (the mirrored edits give the same pairs from the other word).  After that each level joins the frontier with
the edge table on the node and the next code point (one edge at most) and keeps the states whose rest begins with
the edge's label and can go on at its child.  States with nothing left at a word's end are its neighbours.  Two words
part at their first difference, so pairs never come from comparing all words of a group; a state has at most as many ways
on as there are letters.

Nodes are 64-bit hashes of prefixes; neighbours are compared once more, so that a collision can add nothing.

Defined results: null texts hold no words, a null id is written as nothing before the colon, repeated rows count
each, an empty table gives no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import written

LETTERS = "A-Za-zÀ-ÿ"
#: Every join is a shuffled one: Spark takes the packed size of a table for its size, and that of words for that of the rows they are
#: spread out to, so it would broadcast, through the driver's memory, tables many times its limit.
SHUFFLED = "merge"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def noisy_words(documents: DataFrame, *, least_length: int = 7, noise: int = 31) -> DataFrame:
    """(word): every run of letters of ``least_length`` or more, one code point deleted where ``noise`` divides its hash.

    The hash is the crc32 of ``doc_id:run``.  Shorter runs are passed over before hashing, since they only get shorter.
    """
    runs = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
                            F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("_run"))
    runs = runs.select("_id", F.translate("_run", UPPER, LOWER).alias("_run"))
    drawn = runs.select("_run", F.crc32(F.concat("_id", F.lit(":"), "_run")).alias("_h"))
    at = (F.col("_h") % F.length("_run")).cast("int")
    cut = F.concat(F.col("_run").substr(F.lit(1), at), F.col("_run").substr(at + 2, F.length("_run")))
    word = F.when(F.col("_h") % noise == 0, cut).otherwise(F.col("_run"))
    return drawn.select(word.alias("word")).where(F.length("word") >= least_length)


def _half(side: str = "side", spelt: str = "spelt") -> Column:
    """Where a word's later half begins: the halves of the two sides add up to the word."""
    return ((F.length(spelt) + F.col(side)) / 2).cast("int")


def _bit(text: str) -> Column:
    """A bit for the first code point of ``text``."""
    return F.expr(f"shiftleft(1L, ascii({text}) % 64)")


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(paths, edges) of ``words(word)``, over the words (side 0) and reversed (side 1).

    ``paths(side, word, spelt, depth, node, terminal, ways)``: a word's own branching points and ends from its half on
    (``spelt``: as walked on that side, ``ways``: bits of the code points that follow the node).
    ``edges(node, first, label, child, ends, onward)``: ``ends`` is the word that ends at the child, ``onward`` its ways.
    """
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("spelt")),
                              F.struct(F.lit(1).alias("side"), F.reverse("word").alias("spelt")))).alias("s")
    spelt = words.select("word", sides).select("word", "s.*")
    steps = spelt.withColumn("depth", F.explode(F.sequence(_half(), F.length("spelt"))))
    steps = steps.withColumn("node", F.xxhash64("side", F.substring("spelt", F.lit(1), F.col("depth"))))
    following = F.when(F.col("depth") < F.length("spelt"), F.substring("spelt", F.col("depth") + 1, F.lit(1)))
    nodes = (steps.select("node", following.alias("_next")).groupBy("node")
             .agg(F.min("_next").alias("_a"), F.max("_next").alias("_b"), F.bool_or(F.col("_next").isNull()).alias("terminal"),
                  F.bit_or(_bit("_next")).alias("ways"))
             .where("terminal or _a < _b").select("node", "terminal", F.coalesce("ways", F.lit(0).cast("long")).alias("ways")))
    paths = written(steps.join(nodes.hint(SHUFFLED), "node"), "trie-paths")
    ahead = Window.partitionBy("side", "word").orderBy("depth")
    far = paths.withColumn("_c", F.lead(F.struct("node", "depth", "terminal", "ways")).over(ahead)).where(F.col("_c").isNotNull())
    label = F.substring("spelt", F.col("depth") + 1, F.col("_c.depth") - F.col("depth"))
    ends = F.when(F.col("_c.terminal"), F.substring("spelt", F.lit(1), F.col("_c.depth")))
    ends = F.when(F.col("side") == 1, F.reverse(ends)).otherwise(ends)
    edges = (far.select("node", F.col("_c.node").alias("child"), label.alias("label"), ends.alias("ends"), F.col("_c.ways").alias("onward"))
             .groupBy("node", "child").agg(F.min("label").alias("label"), F.min("ends").alias("ends"), F.bit_or("onward").alias("onward"))
             .withColumn("first", F.substring("label", 1, 1)))
    return paths, written(edges, "trie-edges")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all ordered pairs of ``words(word)``, distinct and not empty, that are one edit apart."""
    paths, edges = trie(words)
    own = paths.select("word", "node", "terminal", "side", F.expr("substring(spelt, depth + 1)").alias("rest")).where("rest <> ''")
    # one code point left where a word ends: passed over
    shorter = own.where(F.col("terminal") & (F.length("rest") == 1)).select(
        "word", F.expr("case when side = 0 then substring(word, 1, char_length(word) - 1) else substring(word, 2) end").alias("near"))
    hopeful = F.expr("case when rest = '' then ends is not null else onward & shiftleft(1L, ascii(rest) % 64) <> 0 end")
    left = own.select("word", "rest", "node").join(edges.hint(SHUFFLED), "node").where(F.substring("rest", 1, 1) != F.col("first"))
    tail = F.expr("substring(rest, 2)")
    replaced = (F.col("first") > F.substring("rest", 1, 1)) & F.startswith(tail, F.expr("substring(label, 2)"))
    ways = F.array(F.when(replaced, F.expr("substring(rest, char_length(label) + 1)")),
                   F.when(F.startswith(tail, F.col("label")), F.expr("substring(rest, char_length(label) + 2)")))
    kept = ["word", "ends", "onward", "node", "rest"]
    frontier = written(left.select("word", "ends", "onward", F.col("child").alias("node"), F.explode(F.filter(ways, lambda x: x.isNotNull())).alias("rest"))
                       .where(hopeful).select(*kept), "trie-frontier")
    done = [shorter]
    while True:
        done.append(frontier.where("rest = ''").select("word", F.col("ends").alias("near")))
        going = frontier.where("rest <> ''")
        if going.isEmpty():
            break
        moved = going.select("word", "rest", "node", F.substring("rest", 1, 1).alias("first")).join(edges.hint(SHUFFLED), ["node", "first"])
        moved = moved.where(F.startswith("rest", "label")).select(
            "word", "ends", "onward", F.col("child").alias("node"), F.expr("substring(rest, char_length(label) + 1)").alias("rest"))
        frontier = written(moved.where(hopeful).select(*kept), "trie-frontier")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    once = written(found.where(F.levenshtein("word", "near", 1) == 1).distinct(), "near-words")
    return once.unionByName(once.select(F.col("near").alias("word"), F.col("word").alias("near")))


def variants(words: DataFrame, *, least_times: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words(word, n)``: the commonest near word is a word's form if it is common enough.

    ``form`` is the near word of largest ``n`` (ties: the smallest), if that is ``least_times`` the word's own or more;
    ``root`` follows forms to the last one.
    """
    pairs = near_words(words.select("word"))
    best = (pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("_n")).hint(SHUFFLED), "near")
            .groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("_n")).alias("m"), F.col("near"))).alias("_b")))
    joined = words.select("word", "n").join(best.hint(SHUFFLED), "word", "left")
    common = -F.col("_b.m") >= least_times * F.col("n")
    rows = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(common, F.col("_b.near")).alias("form"), F.when(common, -F.col("_b.m")).alias("form_n")), "forms")
    roots = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:                                                       # counts grow tenfold a step, so chains are short
        roots = written(roots, "roots")
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("_far"))
        longer = roots.join(ahead.hint(SHUFFLED), "root")
        if longer.isEmpty():
            break
        roots = roots.join(ahead.hint(SHUFFLED), "root", "left").select("word", F.coalesce("_far", "root").alias("root"))
    return rows.join(roots.hint(SHUFFLED), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(documents: DataFrame, *, least_length: int = 7, least_count: int = 2, noise: int = 31, least_times: int = 10) -> DataFrame:
    """``variants`` of all words of the whole texts of ``documents(doc_id, text)`` that occur ``least_count`` times or more."""
    counted = noisy_words(documents, least_length=least_length, noise=noise).groupBy("word").agg(F.count("*").alias("n"))
    return variants(written(counted.where(F.col("n") >= least_count), "words"), least_times=least_times)
